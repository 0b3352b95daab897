"""Each operator against a plain one on small tables: nulls, empty and long texts, ties, repeats, clashing columns."""

import base64
import gc
import hashlib
import math
import random
import weakref
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from granary.llm import bpe, embedding_dedup, golay, lm, mixing, quality, registry, repeats, sharding, simhash, textnum, topk, url_filter
from granary.llm import components as components_module
from granary.llm.common import cut
from granary.llm.components import components

from ..conftest import DATA

RNG = random.Random(5)
WORDS = [f"w{k}" for k in range(40)]
LONG = " ".join(RNG.choice(WORDS) for _ in range(2000))
TEXTS = [None, "", " ", "One", "a\tb", LONG, LONG, LONG[:3000] + " changed " + LONG[3000:], "x" * 5000, "é" * 700 + LONG[:900], "end", "ab" * 1000]
TEXTS += [" ".join(RNG.choice(WORDS) for _ in range(RNG.randrange(1, 300))) for _ in range(30)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, f"src{k % 3}" if k % 5 else None, k) for k, t in enumerate(TEXTS)]
    rows += [rows[5], rows[7], (None, "lost id", "src1", 1), (None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, uid long").repartition(3).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def raw(r):
    return (r.text or "").encode()


def closure(n, linked):
    label = list(range(n))
    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return label


def test_components(spark):
    pairs = [(1, 2), (2, 3), (9, 8), (8, 7), (5, 5), (3, 1), (20, 1), (None, 4)] + [(100 + k, 101 + k) for k in range(30)]
    got = {r.id: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 20: 1, 7: 7, 8: 7, 9: 7, **{100 + k: 100 for k in range(31)}}


def test_components_of_many_links_a_node(spark, monkeypatch):
    """Rounds begin with a forest of each task's links, however many links a node has."""
    began, star = [], components_module._large_star
    monkeypatch.setattr(components_module, "_large_star", lambda e: began.append(e.count()) or star(e))
    pairs = [(a, b) for a in range(60) for b in range(a)] + [(100, 200)]
    got = {r.id: r.root for r in components(spark.createDataFrame(pairs, "a long, b long").coalesce(1)).collect()}
    assert got == {**dict.fromkeys(range(60), 0), 100: 100, 200: 100}
    assert began[0] < len(pairs) // 4  # 60 in each task at most
    monkeypatch.setattr(components_module, "HELD", 50)
    u, v = (pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1))
    trees = list(components_module._forests(iter(pa.RecordBatch.from_arrays([u, v], ["u", "v"]).slice(at, 40) for at in range(0, len(pairs), 40))))
    assert len(trees) > 2 and all(0 < t.num_rows < 80 for t in trees)
    assert closure(60, lambda i, j: any((i, j) in zip(t["u"].to_pylist(), t["v"].to_pylist()) for t in trees)) == [0] * 60


def test_url_filter(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://Example.COM/en/x?q#f", "http://www.example.com/en/", "http://notexample.com/en/", "http://a.net/fr/1", "http://net/es/", "http://a.org:80/x", "http://a.com", "http://ÀB.com/", "http://good.org/", "http://bad.org/", "http://a.net/fr/1"]
    html = {12: '<a href="http://a.org:80/">', 4: None, 13: "<a href='//a.net/fr/'>", 10: '<a href="http://good.org">', 5: "<a href=https://good.org/>"}
    df = spark.createDataFrame([(k, u, html.get(k, ""), "x") for k, u in enumerate(urls)], "page_id long, url string, html string, host string")
    got = {r.page_id: r for r in url_filter.filter_urls(df).collect()}
    assert [(got[k].host, got[k].path) for k in (0, 2, 4, 9, 10, 11)] == [("", ""), ("", ""), ("example.com", "/en/x"), ("a.org:80", "/x"), ("a.com", ""), ("ÀB.com".replace("B", "b"), "/")]
    assert [got[k].rule for k in (4, 5, 6, 7, 8, 10)] == ["example.com/en/", "www.example.com/en/", "com/", "net/fr/", "net/es/", None]
    assert got[12].verdict == "allow" and got[12].trust > 0 and got[9].trust > 0  # trust flows two links on
    assert got[13].verdict == "block" and got[13].distrust > 0  # it links to a blocked host
    assert url_filter.filter_urls(df.limit(0)).count() == 0


def test_propagation_is_plain_personalised_pagerank(spark):
    hosts = [f"h{k}.org" for k in range(12)] + ["a.com", "b.com", "x.net"]
    pages = []
    for k in range(80):
        own, path = RNG.choice(hosts), RNG.choice(["/", "/fr/", "/es/x"])
        pages.append((k, f"http://{own}{path}", "".join(f'<a href="http://{RNG.choice(hosts)}/">' for _ in range(RNG.randrange(4)))))
    df = spark.createDataFrame(pages + pages[:5], "page_id long, url string, html string")
    rows = url_filter.filter_urls(df).collect()
    links, seeds = Counter(), {"allow": Counter(), "block": Counter()}
    for _, url, html in pages + pages[:5]:
        own = url.split("/")[2]
        for part in html.split('href="http://')[1:]:
            if (to := part.split("/")[0]) != own:
                links[own, to] += 1
        path = "/" + url.split("/", 3)[3]
        rule = "allow" if own.endswith(".com") else "block" if own.endswith(".net") and path[:4] in ("/fr/", "/es/") else None
        if rule:
            seeds[rule][own] += 1

    def flow(links, seed):
        out, s = Counter(), {h: n / sum(seed.values()) for h, n in seed.items()}
        for (a, _), n in links.items():
            out[a] += n
        x = dict(s)
        for _ in range(400):
            y = {h: 0.15 * s.get(h, 0) for h in hosts}
            for h in hosts:
                if not out[h]:
                    for g, share in s.items():
                        y[g] += 0.85 * x.get(h, 0) * share
            for (a, b), n in links.items():
                y[b] += 0.85 * x.get(a, 0) * n / out[a]
            x = y
        return x

    trust, distrust = flow(links, seeds["allow"]), flow(Counter({(b, a): n for (a, b), n in links.items()}), seeds["block"])
    assert len(rows) == 85
    for r in rows:
        assert math.isclose(r.trust, trust[r.host], abs_tol=1e-3) and math.isclose(r.distrust, distrust[r.host], abs_tol=1e-3)
        if r.rule is None and abs(trust[r.host] - distrust[r.host]) > 2e-3:
            assert r.verdict == ("block" if distrust[r.host] > trust[r.host] else "allow")


def test_embedding_dedup(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((30, 16))
    v = [list(map(float, b + e)) for b in base for e in [0 * b, *(rng.standard_normal((3, 16)) * 0.12)]]
    v += [v[0], [2 * x for x in v[4]], None, [], [0.0] * 16, [float("nan")] * 16, [None] * 16, v[0][:8], [1.0], [3.0]]
    df = spark.createDataFrame([(k, x, 1) for k, x in enumerate(v)] + [(None, v[0], 1)], "vec_id long, embedding array<double>, id int")

    def usable(x):
        return x and all(c is not None and math.isfinite(c) for c in x) and any(x)

    def linked(i, j):
        a, b = v[i], v[j]
        return bool(usable(a) and usable(b) and len(a) == len(b) and np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b) >= 0.95)

    label = closure(len(v), linked)
    for page in (8192, 7):
        got = {r.vec_id: r for r in embedding_dedup.cluster(df, page=page).collect()}
        assert len(got) == len(v) + 1 and got[None].n_links == 0
        for k in range(len(v)):
            assert (got[k].component_id, got[k].n_links) == (label[k], sum(linked(k, j) for j in range(len(v)) if j != k))
    assert embedding_dedup.cluster(df.limit(0)).count() == 0


def test_embedding_dedup_on_planted_links(spark, duck, tmp_path):
    """The query against its SQL on a table with near copies, chains of them and a large group."""
    rng = np.random.default_rng(3)
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    step = lambda v, e: [float(c) for c in (np.array(v) / np.linalg.norm(v) + rng.standard_normal(len(v)) * e / 8)]
    for k in range(0, 60, 3):
        rows.append((10_000 + k, step(rows[k][1], 0.2), 0))
        rows.append((20_000 + k, step(rows[k][1], 0.33), 0))  # about the bound
    for k in range(30):
        rows.append((30_000 + k, step(rows[-1][1], 0.25), 0))  # each near the one before
    rows += [(40_000 + k, step(rows[7][1], 0.1), 0) for k in range(120)] + [(50_000 + k, rows[8][1], 0) for k in range(20)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in registry.op2_embedding_dedup(spark, str(tmp_path)).collect()}
    sql = registry.ORACLES["op2_embedding_dedup"].replace("from embeddings", f"from read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    want = {r[0]: tuple(r[1:]) for r in duck.execute(f"select vec_id, n_links, component_id, kept from ({sql})").fetchall()}
    assert got == want and sum(n > 0 for n, _, _ in got.values()) > 180


def test_sharding(spark, docs, empty):
    got = sharding.shard_by_bytes(docs, 5).collect()
    assert len(got) == docs.count()
    by, where = defaultdict(list), defaultdict(set)
    for r in got:
        by[r.shard].append(r)
        where[r.text_crc32].add(r.shard)
    assert all(sorted(r.slot for r in rows) == list(range(len(rows))) for rows in by.values())
    assert all(len(s) == 1 for s in where.values()) and set(by) <= set(range(5))
    texts = Counter()
    rows = docs.select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()
    for r in rows:
        texts[r.h] += len(raw(r)) + 8
    sizes = [s for _, s in sorted(texts.items())]

    def shards_at(c):
        n, room = 1, c
        for s in sizes:
            if s > room:
                n, room = n + 1, c
            room -= s
        return n

    best = next(c for c in range(max(sizes), sum(sizes) + 1) if shards_at(c) <= 5)
    assert max(sum(r.size for r in rows) for rows in by.values()) == best
    assert {r.text_crc32 for r in got} == {zlib.crc32(raw(r)) for r in rows}
    assert sharding.shard_by_bytes(empty).count() == 0


def test_shards_refuse_a_clash(docs, tmp_path):
    with pytest.raises(ValueError):
        sharding.write(docs.withColumn("Shard", F.lit(1)), str(tmp_path / "out"))


def test_shards_on_disk(spark, docs, tmp_path):
    sharding.write(docs, str(tmp_path / "out"), 5)
    back = spark.read.parquet(str(tmp_path / "out"))
    want = {(r.doc_id, r.text_crc32): r.shard for r in sharding.shard_by_bytes(docs, 5).collect()}
    assert back.count() == docs.count() and {(r.doc_id, zlib.crc32(raw(r))): r.shard for r in back.collect()} == want


def test_sharding_refines_bins(spark, monkeypatch):
    monkeypatch.setattr(sharding, "FIRST_BITS", 1)
    monkeypatch.setattr(sharding, "MORE_BITS", 2)
    sizes = [RNG.randrange(1, 90) for _ in range(200)] + [700]
    hashes = sorted(RNG.randrange(-(2**63), 2**63) for _ in sizes)
    cuts = sharding.cuts(spark.createDataFrame(list(zip(hashes, sizes)), "h long, size long"), 6)

    def greedy(c):
        out, room = [], c
        for h, s in zip(hashes, sizes):
            if s > room:
                out.append(h)
                room = c
            room -= s
        return out

    assert cuts == greedy(next(c for c in range(max(sizes), sum(sizes)) if len(greedy(c)) < 6))


def test_mixing(spark, docs, empty):
    weights = {"src0": 3, "src1": 2, "src2": 1}
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("src"), (F.col("id") % 3).cast("string")).alias("source"), F.lit("x").alias("s"))
    got = mixing.mix(rows, weights, block=10, other=1).orderBy("mix_position").collect()
    assert [r.mix_position for r in got] == list(range(4000)) and len({r.doc_id for r in got}) == 4000
    seen, first_end = Counter(), min(r.mix_position for r in got if r.mix_source == "src0" and r.mix_block == 133)
    for n, r in enumerate(got[:first_end], 1):
        seen[r.source] += 1
        if n % 10 == 0:  # at the ends of blocks each source is less than a block off its share
            assert all(abs(seen[s] / 10 - n / 10 * w / 6) < 1 for s, w in weights.items())
    got = mixing.mix(docs.drop("uid"), weights, block=4).collect()
    assert sorted(r.mix_position for r in got) == list(range(docs.count())) and {r.mix_source for r in got} == {*weights, mixing.OTHER}
    assert mixing.mix(empty).count() == 0
    plan = mixing.mix(rows, weights)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def plain_schedule(rows, weights, other, block):
    """Slot by slot: of the sources with blocks left, the released block with the earliest deadline runs; when a source runs out, windows
    start anew with the others."""
    left = Counter(s if s in weights else mixing.OTHER for s in rows)
    left = {s: [block] * (n // block) + [n % block] * (n % block > 0) for s, n in left.items()}
    units, order = {**weights, mixing.OTHER: other}, []
    while left:
        live = sorted(left)
        total, done, t = sum(units[s] for s in live), dict.fromkeys(left, 0), 0
        while all(left.values()):
            ready = [s for s in live if done[s] * total // units[s] <= t]
            s = min(ready, key=lambda s: (-(-(done[s] + 1) * total // units[s]), s))
            order += [s] * left[s].pop(0)
            done[s] += 1
            t += 1
        left = {s: b for s, b in left.items() if b}
    return order


@pytest.mark.parametrize("block", [1, 4, 7])
def test_mixing_is_the_plain_schedule(spark, docs, empty, block):
    names = RNG.choices(["a", "b", "c", "d", None, "e'\\"], (9, 3, 1, 5, 2, 2), k=331)
    weights = {"a": 3, "b": 4, "c": 1, "d": 2, "e'\\": 2}
    df = spark.createDataFrame(list(enumerate(names)), "doc_id long, source string").repartition(5)
    got = mixing.mix(df, weights, block=block, other=2).orderBy("mix_position").collect()
    assert [r.mix_source for r in got] == plain_schedule(names, weights, 2, block) and [r.mix_position for r in got] == list(range(331))
    assert mixing.mixed_order(docs).count() == docs.count() and mixing.mixed_order(empty).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(docs.withColumn("mix_slot", F.lit(1)))


def test_pfair_windows():
    units = {"a": 7, "b": 5, "c": 1, "d": 3}
    order, total = mixing.period(units), sum(units.values())
    for s, w in units.items():
        for j, t in enumerate(k for k, x in enumerate(order) if x == s):
            assert j * total // w <= t < math.ceil((j + 1) * total / w)


def test_quality(spark, docs, empty):
    good = [" ".join(RNG.choice(("the", "of", "and", "to", *(f"word{RNG.randrange(5000)}",) * 4)) + (". " if k % 9 == 8 else "") for k in range(RNG.randrange(30, 200))) for _ in range(300)]
    bad = [" ".join(f"word{k}***" for k in range(RNG.randrange(30, 90))) for _ in range(30)]
    bad += [" ".join(x for w in range(5) for x in [f"word{RNG.randrange(99)}"] * 20) for _ in range(30)]
    df = spark.createDataFrame([(k, t, 0.5) for k, t in enumerate(good + bad)], "doc_id long, text string, score double")
    got = {r.doc_id: r.kept for r in quality.score(df).collect()}
    assert all(got[k] for k in range(len(good))) and not any(got[k] for k in range(len(good), len(got)))
    assert quality.keep_good(df).columns == df.columns and quality.keep_good(df).count() == len(good)
    odd = quality.score(docs).collect()
    assert len(odd) == docs.count() and all(r.kept for r in odd if r.doc_id in (0, 1, 2))  # without words
    assert quality.score(empty).count() == 0


def test_label_model_is_plain_em():
    """Votes of labellers of known accuracy: EM finds it, and agrees with a row-by-row EM in plain Python."""
    k = len(quality.LABELLERS)
    said = [[0.02 + 0.01 * j for j in range(k)], [0.6 + 0.04 * j for j in range(k)]]
    truth = [int(RNG.random() < 0.2) for _ in range(3000)]
    rows = [[-1 if RNG.random() < 0.3 else int(RNG.random() < said[t][j]) for j in range(k)] for t in truth]
    patterns, counts = np.unique(quality.pattern(np.array(rows)), return_counts=True)
    got = quality.LabelModel(patterns, counts)
    share, q = 0.1, [[0.05] * k, [0.5] * k]
    p = [0.9 if 1 in r else 0.05 for r in rows]
    heard = [any(v >= 0 for v in r) for r in rows]
    for _ in range(100):
        for c in (0, 1):
            weight = [x if c else 1 - x for x in p]
            for j in range(k):
                yes = sum(w for w, r in zip(weight, rows) if r[j] == 1) + (0.01, 0.5)[c]
                q[c][j] = yes / (sum(w for w, r in zip(weight, rows) if r[j] >= 0) + 1)
        share = (sum(x for x, h in zip(p, heard) if h) + 0.1) / (sum(heard) + 1)
        p = []
        for r in rows:
            odds = math.log(share / (1 - share))
            for j, v in enumerate(r):
                if v >= 0:
                    odds += math.log(q[1][j] / q[0][j]) if v else math.log((1 - q[1][j]) / (1 - q[0][j]))
            p.append(1 / (1 + math.exp(-odds)))
    assert abs(got.bad_share - share) < 1e-6 and np.allclose(got.says_bad, q, atol=1e-6)
    assert np.allclose(got.posterior(quality.pattern(np.array(rows))), p, atol=1e-6)
    assert np.abs(got.says_bad - np.array(said)).max() < 0.08 and abs(got.bad_share - 0.2) < 0.03


def test_quality_statistics_are_plain_ones(monkeypatch):
    texts = [(t or "").encode() for t in TEXTS] + [b"Dup dup DUP 12 !!x. a*** b!! wow!! " * 30, b"\x85 \xc3\xa9\xc3\xa9. 1 2 3"]

    def plain(t):
        w = t.split()
        is_letter = lambda c: chr(c).isascii() and chr(c).isalpha() or c >= 128
        letters, digits = ([sum(f(c) for c in x) for x in w] for f in (is_letter, lambda c: 48 <= c <= 57))
        strange = lambda c: not is_letter(c) and not 48 <= c <= 57 and chr(c) not in "!\"'),.:;?]"
        marked = [len(x) > 2 and n > 0 and ((strange(x[-1]) and strange(x[-2])) or x[-2:] == b"!!") for x, n in zip(w, letters)]
        runs = [tuple(w[k : k + 4]) for k in range(len(w) - 3)]
        n = max(len(w), 1)
        return len(w), [
            sum(marked) / n,
            sum(a == b for a, b in zip(w, w[1:])) / n,
            (len(runs) - len(set(runs))) / n,
            sum(65 <= c <= 90 for x in w for c in x) / max(sum(letters), 1),
            sum(a + b == 0 for a, b in zip(letters, digits)) / n,
            math.log(len(set(w))) / math.log(len(w)) if len(w) > 1 else 1,
            sum(len(x) <= 3 and a > 0 for x, a in zip(w, letters)) / n,
            sum(x[-1] in b"!.?" for x in w) / n,
        ]

    from granary.llm import textnum

    for size in (textnum.SLAB, 40):  # where a text is cut into slabs does not matter
        monkeypatch.setattr(textnum.cuts, "__defaults__", (size,))
        words, shares = quality.statistics(texts)
        for k, t in enumerate(texts):
            n, want = plain(t)
            assert words[k] == n and np.allclose(shares[k], want), (t[:40], shares[k], want)


def test_quality_on_labels(spark):
    got = quality.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    n = {(r.quality, r.kept): r["count"] for r in got.groupBy("quality", "kept").count().collect()}
    assert n.get((1, False), 0) == 0 and n.get((0, True), 0) <= 0.1 * n[0, False]


@pytest.fixture(scope="module")
def encoding():
    lines = open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe(spark, docs, empty, encoding):
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    texts = Counter((r.doc_id, r.text or "") for r in docs.collect())
    want = Counter()
    for (d, t), n in texts.items():
        ids = encoding.encode_ordinary(t)
        want[d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()] += n
    assert Counter(tuple(r) for r in bpe.encode(docs, path, pattern).collect()) == want
    by_id = {r.doc_id: r for r in bpe.tokens(docs, path, pattern).collect()}
    assert all(by_id[k].ids == encoding.encode_ordinary(t or "") for k, t in enumerate(TEXTS))
    assert bpe.encode(empty, path, pattern).count() == 0


def test_bpe_odd_texts(encoding):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        codec = bpe.Codec.load(f, public_tokenizers.PATTERN)
    letters = [*"aab  b\n\t'se1 2é中　.!\x0b\x85\xa0x\x1c", "the ", "ing", " \n", "🙂"]
    some = ["".join(RNG.choice(letters) for _ in range(RNG.randrange(40))) for _ in range(3000)] + ["a" * 30000, "ab" * 9000, "éx" * 5000]
    for t in some:
        n, said, decoded = codec.digest(t)
        ids = encoding.encode_ordinary(t)
        assert said == " ".join(map(str, ids)).encode() and n == len(ids) and decoded == t.encode() and codec.encode(t).tolist() == ids


def plain_merge(ranks, piece):
    parts = [piece[k : k + 1] for k in range(len(piece))]
    while best := min(((ranks[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks), default=None):
        parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
    return [ranks[x] for x in parts]


def test_bpe_pre_tokens_share_a_queue():
    """Ranks in any order, so that a merge often makes a pair of lower rank."""
    rng = random.Random(3)
    longer = list({"".join(rng.choice("abc") for _ in range(rng.randrange(2, 7))).encode() for _ in range(300)})
    rng.shuffle(longer)
    ranks = {bytes([k]): k for k in range(256)} | {x: 256 + k for k, x in enumerate(longer)}
    codec = bpe.Codec(ranks, public_tokenizers.PATTERN)
    pieces = ["".join(rng.choice("abc") for _ in range(rng.randrange(2, 30))).encode() for _ in range(4000)]
    pieces = [x for x in pieces if x not in ranks]
    want = [plain_merge(ranks, x) for x in pieces]
    assert codec.merge_all(pieces) == want
    assert [codec.merge(x) for x in pieces[:300]] == want[:300]
    text, calls, merge_all = " ".join(x.decode() for x in pieces), [], codec.merge_all
    codec.merge_all = lambda some: calls.append(len(some)) or merge_all(some)
    codec.learn([text, text], codec.parts)
    n, said, decoded = codec.digest(text)
    assert decoded == text.encode() and n == said.count(b" ") + 1
    assert len(calls) <= 2 + len(pieces) // bpe.MERGED  # together, not one by one


def test_bpe_new_parts_are_made_together(monkeypatch, encoding):
    """Parts that are new go into the caches at once; nothing of them is merged or joined one by one, whatever the white space between them."""
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        codec = bpe.Codec.load(f, public_tokenizers.PATTERN, 5000)
    rng, alone = random.Random(15), []
    word = lambda: "".join(rng.choice("aeiounrst\nßéç中,.'s1") for _ in range(rng.randrange(1, 14)))
    texts = [rng.choice((" ", " ", "  ", " \t")).join(word() for _ in range(rng.randrange(40))) + rng.choice(("", "", " ")) for _ in range(300)] + ["", " ", "\n"]
    for cache in codec.heads, codec.parts, codec.arrays:
        monkeypatch.setattr(cache, "make", lambda x, make=cache.make: alone.append(x) or make(x))
    for some in texts[:150], texts[150:], texts:
        told = [codec.tell(*cut) for cut in codec.learn(some, codec.parts)]
        joined = [codec.join(*cut) for cut in codec.learn(some, codec.arrays, " ")]
        for t, (n, said, decoded), ids in zip(some, told, joined, strict=True):
            want = encoding.encode_ordinary(t)
            assert ids.tolist() == want and n == len(want) and said == " ".join(map(str, want)).encode() and decoded == t.encode()
    assert not [x for x in alone if len(x) < bpe.CACHED_BYTES]
    assert sum(len(c) + len(c.old) for c in (codec.heads, codec.parts, codec.arrays)) <= 30_000


def test_bpe_texts_are_looked_through_in_groups(monkeypatch):
    monkeypatch.setattr(bpe, "LEARNED", 10)
    assert list(bpe.groups(["a" * 4, "b" * 6, "", "c", "d" * 30, "e"])) == [["a" * 4, "b" * 6, ""], ["c"], ["d" * 30], ["e"]]
    assert list(bpe.groups([])) == []


def test_bpe_pairs_of_tokens():
    rng = random.Random(16)
    for size in 0, 1, 40, 3000:
        longer = list({bytes(rng.choice(b"abcd") for _ in range(rng.randrange(2, 9))) for _ in range(size)})
        ranks = {bytes([k]): k for k in range(256)} | {x: 256 + k for k, x in enumerate(longer)}
        pairs, every = bpe.Pairs(ranks, len(ranks) + 1), list(ranks)
        some = [(rng.choice(every), rng.choice(every)) for _ in range(3000)] + [(x[:k], x[k:]) for x in longer for k in range(1, len(x)) if x[:k] in ranks and x[k:] in ranks]
        left, right = np.array([(ranks[a], ranks[b]) for a, b in some], np.int64).T
        assert pairs.ranks(left, right).tolist() == [ranks.get(a + b, -1) for a, b in some]
        assert (pairs.ranks(left, np.full(len(left), len(ranks))) == -1).all()  # the end of a pre-token makes no pair


def plain_repeats(texts, length):
    seen = Counter(t[p : p + length] for t in texts for p in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def plain_passage_words(texts, length=51):
    seen = Counter(tuple(t[p : p + length]) for t in texts for p in range(len(t) - length + 1))
    return [len({j for p in range(len(t) - length + 1) if seen[tuple(t[p : p + length])] > 1 for j in range(p, p + length)}) for t in texts]


@pytest.mark.parametrize("many", [1 << 16, 3])
def test_repeats(spark, docs, empty, many, monkeypatch):
    monkeypatch.setattr(repeats, "MANY", many)
    rows = docs.collect()
    want = Counter(zip((r.doc_id for r in rows), plain_repeats([raw(r) for r in rows], repeats.BYTES.length)))
    out = repeats.remove(docs).collect()
    assert Counter((r.doc_id, (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in out) == want
    assert Counter((r.doc_id, r.n_passage_words) for r in out) == Counter(zip((r.doc_id for r in rows), plain_passage_words([raw(r).split() for r in rows])))
    assert repeats.remove(empty).count() == 0


def test_repeats_with_shared_passages(spark):
    passage = [bytes(RNG.randrange(97, 123) for _ in range(n)).decode() for n in (399, 400, 401, 500, 900)]
    fill = lambda: bytes(RNG.randrange(97, 123) for _ in range(RNG.randrange(300))).decode()
    texts = [fill() + RNG.choice(passage) + fill() + RNG.choice(passage) + fill() for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    want = dict(enumerate(plain_repeats([t.encode() for t in texts], repeats.BYTES.length)))
    assert {r[0]: tuple(r[1:5]) for r in repeats.remove(df).collect()} == want
    kept = {r.doc_id: r.text for r in repeats.strip(df).collect()}
    assert all(hashlib.sha256(kept[k].encode()).hexdigest() == want[k][3] for k in want)


def test_strip_of_odd_rows(spark, docs, empty):
    """Nulls, empty and repeated rows, and extra columns of the names that are used inside."""
    extra = {"t": F.lit("x"), "spans": F.lit(1), "copied": F.lit(True), "rep": F.lit(None).cast("long"), "n_chars": F.lit(0).cast("long")}
    df = docs.withColumns(extra)
    rows, out = docs.collect(), repeats.strip(df)
    assert out.columns == df.columns and repeats.strip(empty.withColumns(extra)).count() == 0
    seen = Counter(raw(r)[p : p + 400] for r in rows for p in range(len(raw(r)) - 399))
    want = Counter()
    for r in rows:
        gone = {j for p in range(len(raw(r)) - 399) if seen[raw(r)[p : p + 400]] > 1 for j in range(p, p + 400)}
        left = bytes(c for k, c in enumerate(raw(r)) if k not in gone).decode(errors="ignore")
        want[r.doc_id, None if r.text is None else left] += 1
    got = out.collect()
    assert Counter((r.doc_id, r.text) for r in got) == want
    assert all(r.n_chars == len(r.text or "") and (r.t, r.spans, r.copied) == ("x", 1, True) for r in got)


def test_repeated_passages_in_words(spark):
    word = lambda n: "".join(RNG.choice("abcdefghijklmnop") for _ in range(n))
    passages = [[word(RNG.randrange(3, 6)) for _ in range(n)] for n in (50, 51, 60, 75)] + [[word(12) for _ in range(n)] for n in (45, 80)]
    fill = lambda: [word(7) for _ in range(RNG.randrange(1, 40))]
    parts = [[*fill(), *RNG.choice(passages)[RNG.randrange(2) :], *fill(), *RNG.choice(passages), *fill()] for _ in range(60)]
    texts = [RNG.choice((" ", "\n", "  ")).join(p) for p in parts] + [None, "", " ".join(passages[0])]
    rows = [p or [] for p in (*parts, [], [], passages[0])]
    windows = Counter(tuple(p[k : k + 51]) for p in rows for k in range(len(p) - 50))
    want = []
    for p in rows:
        gone = {j for k in range(len(p) - 50) if windows[tuple(p[k : k + 51])] > 1 for j in range(k, k + 51)}
        want.append([w for k, w in enumerate(p) if k not in gone])
    df = spark.createDataFrame([(k, t, 0) for k, t in enumerate(texts)], "doc_id long, text string, n_chars long").repartition(4).cache()
    got = {r.doc_id: r for r in repeats.strip(df, words=True).collect()}
    assert [(got[k].text or "").split() for k in range(len(texts))] == want and any(len(w) < len(p) for w, p in zip(want, rows))
    assert all(got[k].n_chars == len(got[k].text) for k, t in enumerate(texts) if t is not None)


def test_long_texts_in_pieces(monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 1000)
    t = bytes(RNG.randrange(97, 123) for _ in range(7000))
    texts = [t, t[3000:4100] + t[:500], b"short"]
    given = repeats.symbols(texts, repeats.BYTES)
    parts = repeats.anchors(given, repeats.BYTES)
    monkeypatch.setattr(repeats, "PIECE", 1 << 20)
    whole = repeats.anchors(given, repeats.BYTES)
    assert all(np.array_equal(parts[k], whole[k]) for k in whole)


def thue_morse_pair():
    """Two unlike texts of 400 bytes whose polynomial hashes modulo 2 ** 64 are equal for every odd base."""
    change = (-1, 8, -27, 48, -42, 0, 42, -48, 27, -8, 1)
    fill = [RNG.randrange(32, 127) for _ in range(400)]
    one, two = list(fill), list(fill)
    for k, d in enumerate(change):
        one[32 * k], two[32 * k] = 78, 78 + d
    return bytes(one).decode(), bytes(two).decode()


def test_unlike_texts_of_equal_hash(spark):
    """Places are told by bytes: what a hash modulo 2 ** 64 holds for equal stays."""
    pairs = [thue_morse_pair() for _ in range(40)]
    texts = [side[k] + tail for side, tail in zip(pairs, [f" tail {k} " + "abc"[k % 3] * 5 for k in range(40)]) for k in (0, 1)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want = dict(enumerate(plain_repeats([t.encode() for t in texts], 400)))
    assert {r[0]: tuple(r[1:5]) for r in repeats.remove(df).collect()} == want


def test_msd_sort():
    rows = np.array([[RNG.randrange(3) for _ in range(6)] for _ in range(500)], np.uint64)
    group = np.array([RNG.randrange(4) for _ in range(500)])
    order, label = repeats.msd_sort(group, rows)
    plain = sorted((g, *r) for g, r in zip(group.tolist(), rows.tolist()))
    got = [(g, *r) for g, r in zip(group[order].tolist(), rows[order].tolist())]
    assert sorted(got) == plain  # a row leaves when it is alone, so only groups of several are told from others
    assert [g[0] for g in got] == [p[0] for p in plain]
    count = Counter(got)
    assert all((label == label[k]).sum() == count[got[k]] for k in range(500))
    assert got == plain

def test_golay():
    words = np.array([RNG.randrange(1 << 23) for _ in range(300)])
    flips = [0, *(1 << k for k in range(23))]
    near = golay.near(words)
    for f in flips:
        for g in flips:
            other = golay.near(words ^ f ^ g)
            assert all(set(a) & set(b) - {-1} for a, b in zip(near.tolist(), other.tolist()))


def test_simhash(spark, docs, empty):
    def print_of(t):
        w = t.lower().split()
        runs = [b" ".join(w[k : k + 4]) for k in range(max(1, len(w) - 3))] if w else []
        h = [xxhash.xxh64_intdigest(r, 42) for r in runs]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    rows = docs.collect()
    fps = [print_of(raw(r)) for r in rows]
    label = closure(len(rows), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 4)
    least = {}
    for r, x in zip(rows, label):
        least[x] = min((d for d in (least.get(x), r.doc_id) if d is not None), default=None)
    want = Counter((r.doc_id, f"{f:016x}", least[x]) for r, f, x in zip(rows, fps, label))
    assert Counter(tuple(r) for r in simhash.cluster(docs).collect()) == want
    assert simhash.cluster(empty).count() == 0


def test_simhash_keys_lose_no_pair():
    base = np.array([RNG.randrange(1 << 64) for _ in range(200)], np.uint64)
    for errors in range(5):
        other = base.copy()
        for k in range(len(other)):
            for b in RNG.sample(range(64), errors):
                other[k] ^= np.uint64(1 << b)
        (i, a), (j, b) = simhash.keys(base.view(np.int64)), simhash.keys(other.view(np.int64))
        assert {int(x) for x in i} == set(range(200))
        assert all(set(a[i == k].tolist()) & set(b[j == k].tolist()) for k in range(200))


def test_keep_one(spark, docs, empty):
    words = lambda n: [f"t{RNG.randrange(3000)}" for _ in range(n)]
    base = [words(300) for _ in range(20)]
    rows = [" ".join(b) for b in base]
    for b in base[:10]:
        for _ in range(4):
            w = list(b)
            w[RNG.randrange(300)] = "edited"
            rows.append(" ".join(w))
    rows += rows[:5] + [rows[0].upper()]
    df = spark.createDataFrame([(k, t, 1) for k, t in enumerate(rows)], "doc_id long, text string, node int")
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns and kept.count() == 20
    assert {r.doc_id for r in kept.collect()} >= set(range(10, 20))
    assert simhash.keep_one(empty).count() == 0
    assert simhash.keep_one(docs).count() < docs.count()


def no_pair_stays(spark, texts):
    """Ids of the rows that stay: no two at 0.8 or more, and at least one of each group that pairs at 0.8 or more connect."""
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    kept = {r.doc_id for r in simhash.keep_one(df).collect()}
    sets = [set(simhash.shingles(t.encode()).tolist()) for t in texts]
    alike = lambda i, j: len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
    assert not any(alike(i, j) for i in kept for j in kept if i < j)
    label = closure(len(texts), alike)
    assert {label[k] for k in kept} == set(label)
    return kept


def test_keep_one_of_texts_longer_shorter_or_changed_in_a_block(spark):
    words = lambda n: [f"u{RNG.randrange(3000)}" for _ in range(n)]
    texts = []
    for n in (40, 100, 300, 1000) * 2:
        b = words(n)
        at = RNG.randrange(n // 2)
        part = n // 12
        copies = (b, b + words(n * 23 // 100), words(n // 6) + b, b[: n * 83 // 100], b[n // 10 :], b[:at] + words(part) + b[at + part :])
        texts += [" ".join(c) for c in copies]
    assert len(no_pair_stays(spark, texts)) < len(texts) / 2


def test_keep_one_in_large_groups(spark, monkeypatch):
    """Groups beyond the size whose pairs are written one by one are compared in pages, with the same result."""
    monkeypatch.setattr(simhash, "FEW", 3)
    monkeypatch.setattr(simhash, "PAGE", 5)
    base = [f"p{RNG.randrange(3000)}" for _ in range(120)]
    texts = []
    for _ in range(30):
        b = list(base)
        for at in RNG.sample(range(120), RNG.randrange(3, 9)):
            b[at] = f"q{RNG.randrange(10**6)}"
        texts.append(" ".join(b))
    no_pair_stays(spark, texts + [" ".join(base[:k]) for k in range(60, 120, 7)])


def test_keep_one_in_chains_and_in_groups_of_the_same_words(spark):
    first = [f"v{RNG.randrange(3000)}" for _ in range(300)]
    texts = []
    for k in range(3):  # the same words in three orders: one fingerprint, no common shingles
        b = RNG.sample(first, len(first))
        texts += [" ".join(b)] + [" ".join([*b[:at], f"edit{k}", *b[at + 1 :]]) for at in RNG.sample(range(300), 4)]
    chain = [f"c{RNG.randrange(3000)}" for _ in range(300)]
    for k in range(9):  # each version is like the one before
        texts.append(" ".join(chain))
        chain = chain[15:] + [f"more{k}x{j}" for j in range(15)]
    assert len(no_pair_stays(spark, texts) & set(range(15))) == 3


def test_topk(spark):
    rng = np.random.default_rng(2)
    v = {k: [float(x) for x in np.round(rng.standard_normal(6), 1)] for k in range(120)}
    v |= {200: None, 201: [float("inf")] * 6, 202: [None] * 6, 250: [1.0, 2.0], 300: [], 301: [0.0] * 6}
    df = spark.createDataFrame([(k, x, 1) for k, x in v.items()] + [(None, v[0], 1), (0, v[0], 1), (7, v[7], 1)], "vec_id long, embedding array<double>, score int")
    q = {k: [math.floor(256 * c) for c in x] for k, x in v.items() if x is not None and all(c is not None and math.isfinite(c) for c in x)}
    want = set()
    for k in q:
        if k % 50 == 0:
            s = sorted((-sum(a * b for a, b in zip(q[k], q[j])), j) for j in q if j != k)[:5]
            want |= {(k, r, j, -x) for r, (x, j) in enumerate(s, 1)}
    for size in ((16384, 1024), (13, 2)):
        assert {tuple(r) for r in topk.search(df, rows=size[0], queries=size[1]).collect()} == want
    several = [(k, list(map(float, rng.integers(-3, 4, 5)))) for k in [*range(0, 101, 5)] * 4]  # ids with four vectors
    best = Counter()
    for a, x in several:
        for b, y in several:
            if a % 50 == 0 and a != b:
                best[a, b] = max(best.get((a, b), -(10**9)), sum(int(256 * i) * int(256 * j) for i, j in zip(x, y)))
    want = set()
    for a in (0, 50, 100):
        want |= {(a, r, b, s) for r, (s, b) in enumerate(sorted(((s, b) for (q, b), s in best.items() if q == a), key=lambda x: (-x[0], x[1]))[:5], 1)}
    twice = spark.createDataFrame(several, "vec_id long, embedding array<double>").repartition(4)
    for size in ((16384, 1024), (13, 1)):
        assert {tuple(r) for r in topk.search(twice, rows=size[0], queries=size[1]).collect()} == want
    assert topk.search(df.limit(0)).count() == 0
    with pytest.raises(OverflowError):
        topk.accumulate(np.array([[1e12]]), np.array([[1e12]]))


def test_repeats_slide_in_few_passes():
    v = np.random.default_rng(1).integers(0, 1 << 63, 1000).astype(np.uint64) * np.uint64(2)
    for w in (1, 2, 5, 48, 369, 1000, 1001):
        for least in (np.minimum, np.maximum):
            calls = []
            got = repeats.slide(v, w, lambda a, b: calls.append(len(a)) or least(a, b))  # noqa: B023
            assert got.tolist() == [int(least.reduce(v[k : k + w])) for k in range(len(v) - w + 1)]
            assert len(calls) <= w.bit_length()


def test_repeats_words_are_numbered_together():
    kind = repeats.WORDS
    data = [b"b a\x0bA  a\xc3\x80\x1c", b" ".join(b"w%d" % (k % 50) for k in range(kind.wide)), b"", b"a b", b"b a\x0bA  a\xc3\x80\x1c"]
    skip = np.array([2, 0, 5, 1, 0])
    which, each, words = textnum.numbered(pa.array([b" a ", *data], pa.large_binary()))
    assert [words[k].as_py() for k in which.tolist()] == [w for d in [b"a", *data] for w in d.split()] and len(set(words.to_pylist())) == len(words)
    assert each.tolist() == [1, *(len(d.split()) for d in data)]
    grid, size = repeats.matrix(data, skip, kind)
    number: dict[bytes, int] = {}
    for row, k, d in zip(grid.tolist(), skip.tolist(), data):
        want = [number.setdefault(w, len(number) + 1) for w in d.split()]
        assert row == [0] * k + want + [0] * (len(row) - k - len(want))
    assert size.tolist() == [len(d.split()) for d in data]


def test_repeats_surroundings_without_a_call_for_each(monkeypatch):
    part = " ".join(RNG.choice(WORDS) for _ in range(300))
    texts = [part, "x " + part, part + " y", part[5:], part, "", "short", part + " " + part]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    monkeypatch.setattr(repeats, "digest", None)
    for kind in (repeats.BYTES, repeats.WORDS):
        (out,) = repeats._sketch(kind)([batch])
        digit, around = {}, {}
        for text, row in zip(texts, out.to_pylist()):
            (s,) = repeats.symbols([text.encode()], kind)
            for x in row["anchors"]:
                lo, hi = max(0, x["a"] - kind.reach), min(row["size"], x["a"] + kind.length)
                whole = (x["a"] - lo, hi - x["a"], tuple(s.of[lo:hi].tolist()))
                assert digit.setdefault((x["x"], x["y"]), whole) == whole and around.setdefault(whole, (x["x"], x["y"])) == (x["x"], x["y"])
        assert len(digit) > 5


def test_lm(spark, docs, empty):
    rows = docs.collect()
    held = [zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 10 == 0 for r in rows]
    tokens = [[*raw(r).lower().split(), None] for r in rows]
    c = Counter(t for x, h in zip(tokens, held) if not h for t in x)
    n, v = sum(c.values()), len(c)
    base = [sum(math.log10((c[t] + 0.1) / (n + 0.1 * (v + 1))) for t in x) for x in tokens]
    want = sorted(((r.doc_id is None, r.doc_id or 0), h, len(x), sum(c[t] > 0 for t in x), n, round(b, 6)) for r, h, x, b in zip(rows, held, tokens, base))
    got = lm.score(docs).collect()
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert lm.score(empty).count() == 0


def test_lm_learns(spark):
    """On held-out documents the model beats the counts alone by far more than 5 %."""
    got = lm.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1] * 0.85


def test_lm_is_the_same_for_any_partitions(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    one, many = ({r.doc_id: r for r in lm.score(docs.repartition(n)).collect()} for n in (1, 16))
    assert one.keys() == many.keys()
    for k, r in one.items():
        assert r[:5] == many[k][:5] and math.isclose(r.base_score, many[k].base_score, rel_tol=1e-9) and math.isclose(r.score, many[k].score, rel_tol=1e-4)


def test_lm_score_is_the_plain_one(spark, docs):
    """score, token by token from the model's weights and counts; the probabilities of all events in a context add up to one."""
    held = docs.select("doc_id", "text", lm.is_held_out(F.col("doc_id")).alias("held_out"))
    model = lm.fit(held.where(~F.col("held_out")).select("doc_id", "text"))
    count = {r.h % (1 << 64): r.c for r in model.counts.collect()}
    kinds, w = model.kinds, model.weights
    rank = {int(h): k for k, h in enumerate(kinds.table)}
    total = Counter()  # of the last bin of each group

    def kind(h):
        if h in rank:
            return int(kinds.group[rank[h]]), int(kinds.bin[rank[h]])
        return int(kinds.by_ending[h & 255]), lm.BINS - 1

    by_class = Counter()
    for h, c in count.items():
        by_class[kind(h)] += c

    def row(part, first, x):
        return int(lm.scramble(np.array([x + part + 1], np.uint64))[0] % np.uint64(lm.PART[part])) + first

    def plain(text):
        hs = [lm.token(x) for x in (text or "").encode().lower().split()] + [lm.END]
        code = [rank.get(h, lm.RARE + (h & 255)) for h in hs]
        out = 0.0
        for k, h in enumerate(hs):
            word = [lm.BEGIN if k < b else code[k - b] for b in (1, 2)]
            g = [lm.GROUPS if k < b else kind(hs[k - b])[0] for b in (1, 2, 3)]
            f = [row(0, 0, word[0]), row(1, lm.PART[0], word[1]), row(2, lm.PART[0] + lm.PART[1], (g[0] * 17 + g[1]) * 17 + g[2])]
            own, b = kind(h)
            z = w.group_bias + sum(w.group[r].astype(float) for r in f)
            y = w.bin_bias[own] + sum(w.bin[r * lm.GROUPS + own].astype(float) for r in f)
            out += (z[own] - np.log(np.exp(z).sum()) + y[b] - np.log(np.exp(y).sum())) / math.log(10)
            if b < lm.BINS - 1:
                out += math.log10(count[h] / by_class[own, b])
            else:
                out += math.log10(count[h]) + kinds.seen[own] if h in count else kinds.unseen[own]
        return out

    got = sorted(((r.doc_id is None, r.doc_id or 0, r.n_tokens), r.score) for r in lm.score_with(model, held).collect())
    want = sorted(((r.doc_id is None, r.doc_id or 0, len((r.text or "").encode().split()) + 1), plain(r.text)) for r in docs.collect())
    assert [a for a, _ in got] == [a for a, _ in want]
    assert np.allclose([a for _, a in got], [a for _, a in want], rtol=1e-4)
    for g in range(lm.GROUPS):  # within the last bin of a group: what is known and one unknown token
        known = sum(c for h, c in count.items() if kind(h) == (g, lm.BINS - 1))
        assert math.isclose(known * 10 ** kinds.seen[g] + 10 ** kinds.unseen[g], 1) or not known


def test_lm_tokens_without_a_call_for_each(monkeypatch):
    texts = [b"", b" The\x0bcat \xc3\x80\xff  a\x1cb\x00 ", b"\r\n", b"x THE x " + b"q" * 300 + b" \xe2\x80\x83z", b"the"]
    tokens = [[lm.token(w) for w in t.lower().split()] + [lm.END] for t in texts]
    table = np.array([lm.token(b"x"), lm.END, lm.token(b"the")], np.uint64)
    rank = {h: k for k, h in enumerate(table.tolist())}
    lm._endings()
    monkeypatch.setattr(lm, "token", None)
    for size in (1 << 24, 1):
        monkeypatch.setattr(lm, "PIECE", size)
        for coder, code in ((lm.Coder(), {}), (lm.Coder(table), rank)):
            codes, sizes = coder.all(texts)
            assert codes.tolist() == [code.get(h, h) for t in tokens for h in t] and sizes.tolist() == [len(t) for t in tokens]
    codes, sizes = lm.Coder(table).all([])
    assert not len(codes) and not len(sizes)


def test_lm_softmax_of_any_size():
    for most in (1, 50, 300):  # beyond SAFE the rows' maxima are taken off
        z = np.random.default_rng(most).uniform(-most, most, (1000, lm.BINS)).astype(np.float32)
        p = np.exp(z.astype(float) - z.max(axis=1, keepdims=True))
        assert np.abs(lm.softmax(z.copy()) - p / p.sum(axis=1, keepdims=True)).max() < 1e-6
        w = lm.Weights(np.zeros((lm.ROWS, lm.GROUPS), np.float32), np.zeros((lm.ROWS * lm.GROUPS, lm.BINS), np.float32), z[0], z[1:17])
        group, bin_ = np.arange(16), np.arange(16)[::-1]
        want = np.log(p / p.sum(axis=1, keepdims=True)) if most < 300 else z - z.max(axis=1, keepdims=True) - np.log(p.sum(axis=1, keepdims=True))
        assert np.abs(w.chosen(np.zeros((3, 16), np.int64), group, bin_) - (want[0, group] + want[1 + group, bin_])).max() < 1e-3


def test_lm_long_texts_in_parts(monkeypatch):
    text = " ".join(RNG.choice(WORDS) for _ in range(3000)).encode()
    whole = lm.Coder().all([text, b""])
    monkeypatch.setattr(lm, "CHUNK", 50)
    parts = lm.Coder().all([text, b""])
    assert np.array_equal(parts[0], whole[0]) and parts[1].tolist() == whole[1].tolist() == [3001, 1]


@pytest.mark.parametrize("name", registry.ORACLES)
def test_sql(spark, duck, name):
    got = registry.QUERIES[name](spark, DATA).toPandas()
    want = duck.execute(registry.ORACLES[name]).df()
    names = sorted(got.columns)
    plain = lambda f: sorted([["null" if x is None or x != x else str(x) for x in r] for r in f[names].values.tolist()])
    assert names == sorted(want.columns) and plain(got) == plain(want)


def test_slabs_cut_between_words():
    from granary.llm import textnum

    for size in (5, 17, 100):
        for _ in range(100):
            texts = [bytes(RNG.choice(b"ab \n") for _ in range(RNG.randrange(60))) for _ in range(RNG.randrange(1, 6))]
            words, ends = [[] for _ in texts], [0] * len(texts)
            for s in textnum.slabs(texts, size=size):
                for a, b, d in zip(s.start, s.end, s.doc):
                    words[d].append(s.buf[a:b].tobytes())
                for d in range(s.first, s.last + 1) if s.whole else ():
                    ends[d] += 1
            assert words == [t.split() for t in texts] and ends == [1] * len(texts)


def test_sketches_lose_no_pair_that_is_alike(spark, monkeypatch):
    monkeypatch.setattr(simhash, "WORDS", 64)
    rng = random.Random(11)
    sets, numbers = [], lambda n: [rng.randrange(1 << 64) for _ in range(n)]
    for n in (1, 2, 5, 9, 31, 33, 120, 130, 700):
        for gone in (0, n // 18, n // 9, n // 5, n // 2):
            base = numbers(n)
            sets += [set(base), set(base[gone:]), set(base[gone:] + numbers(gone)), set(base + numbers(gone))]
    d = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    k = np.array([x for s in sets for x in s], np.uint64)
    n = np.array([len(s) for s in sets])
    found = simhash.sketch_pairs(n, simhash.sketches(d, k, n), 0.8)
    got = {(min(p), max(p)) for i, j in found for p in zip(i.tolist(), j.tolist())}
    share = {(i, j): len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for i in range(len(sets)) for j in range(i + 1, len(sets))}
    assert got >= {p for p, x in share.items() if x >= 0.8}
    assert not any(share[i, j] < 0.3 for i, j in got if min(n[i], n[j]) > 30)


def test_keep_one_where_sketches_take_several_pages(spark, monkeypatch):
    for name, n in (("FEW", 3), ("PAGE", 5), ("SKETCHES", 7)):
        monkeypatch.setattr(simhash, name, n)
    rng = random.Random(13)
    base = [f"p{rng.randrange(3000)}" for _ in range(120)]
    texts = [" ".join(base[:k]) for k in range(60, 120, 7)]
    for _ in range(25):
        b = list(base)
        for at in rng.sample(range(120), rng.randrange(3, 9)):
            b[at] = f"q{rng.randrange(10**6)}"
        texts.append(" ".join(b))
    no_pair_stays(spark, texts)


def test_only_texts_that_may_be_alike_are_dealt_to_pages(spark, monkeypatch):
    """Large groups hang together by texts that share a line or two; their sets must not be sent to every page of all of these texts."""
    rows, rng = {}, random.Random(12)

    def counted(df, name="cut", narrow=False):
        out = cut(df, name, narrow)
        rows[name] = out.count()
        return out

    monkeypatch.setattr(simhash, "cut", counted)
    monkeypatch.setattr(simhash, "FEW", 3)
    lines = [" ".join(f"l{rng.randrange(3000)}" for _ in range(30)) for _ in range(10)]
    texts = [" ".join([*rng.sample(lines, 4), *(f"own{rng.randrange(10**6)}" for _ in range(40))]) for _ in range(40)]
    assert len(no_pair_stays(spark, texts)) == 40
    assert rows["chained"] > 20 and "large-sets" not in rows


def test_the_search_for_copies_lets_go_of_the_encoder(monkeypatch):
    """A worker that has encoded must not hold the encoder's caches while it looks for copies."""
    monkeypatch.setattr(bpe, "_codecs", {("name", "pattern", 1): None})
    assert not list(simhash._word_prints(1)(iter([]))) and not bpe._codecs


def test_an_encoder_that_is_let_go_is_gone(monkeypatch):
    """Its caches refer to it: without a look for cycles it stays as long as nothing else asks for one."""
    codec = bpe.Codec({bytes([k]): k for k in range(256)}, public_tokenizers.PATTERN)
    codec.digest("some text")
    monkeypatch.setattr(bpe, "_codecs", {("name", "pattern", 1): codec})
    left = weakref.ref(codec)
    del codec
    gc.disable()
    try:
        bpe.forget()
        assert left() is None
    finally:
        gc.enable()


def test_passes_sort_only_groups_whose_digits_differ(monkeypatch):
    group, by = np.repeat([4, 2, 9], 5), np.repeat(np.array([[7, 1], [3, 3], [5, 0]], np.uint64), 5, axis=0)
    monkeypatch.setattr(np, "lexsort", None)  # none of these groups needs it
    order, label = repeats.msd_sort(group, by)
    assert group[order].tolist() == sorted(group.tolist()) and label.tolist() == [0] * 5 + [5] * 5 + [10] * 5


def test_marks_are_those_of_plain_comparison():
    rng, kind = random.Random(14), repeats.Windows(10, 3, False)
    for _ in range(40):
        data, group, skip = [], [], []
        for g in range(6):
            base = bytes(rng.choice(b"abc") for _ in range(kind.wide))
            for _ in range(rng.randrange(1, 6)):
                b = bytearray(base)
                b[rng.randrange(kind.wide)] = rng.choice(b"abc")
                lo, hi = rng.choice((0, 0, rng.randrange(kind.half + 1))), kind.wide - rng.choice((0, 0, rng.randrange(kind.half)))
                data.append(bytes(b[lo:hi]))
                group.append(g)
                skip.append(lo)
        grid, size = repeats.matrix(data, np.array(skip), kind)
        got = repeats.marks(grid, np.array(skip), size, np.array(group), kind)
        at = lambda k, x: data[k][x - skip[k] : x - skip[k] + kind.length] if skip[k] <= x and x + kind.length <= skip[k] + len(data[k]) else None
        seen = Counter((group[k], x, at(k, x)) for k in range(len(data)) for x in range(kind.half + 1))
        assert got.tolist() == [[at(k, x) is not None and seen[group[k], x, at(k, x)] > 1 for x in range(kind.half + 1)] for k in range(len(data))]
