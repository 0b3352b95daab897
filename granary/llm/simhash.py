"""SimHash near-dedup with Golay-code fuzzy hashing.

A 64-bit fingerprint is three segments of 23, 23 and 18 bits. Fingerprints 4 or fewer bits apart have two segments
with 2 or fewer errors together (the third has at least as many as either). A segment decodes to its nearest codeword's
index, and with its neighbours one bit away to several. For each pair of segments a fingerprint's keys join all indices
of one segment with the nearest of the other, both ways round; two fingerprints that meet the error bound share a key.
Fingerprints with a common key are compared, and links are reduced to a forest within each key at once, so that
what leaves a key is linear in its size. Equal fingerprints are one before any of this: a group of copies, however
large, is one row, and a key's group is bounded by distinct fingerprints, not by documents.

Defined cases: a null text is an empty one; a text without words has fingerprint zero and is linked like any other; a
null doc_id never names a component unless it has no other; repeated rows share one component; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe, golay
from .arrow import longs, slices
from .common import cut, partitions, release
from .components import components, flatten, unite
from .textnum import SLAB as SLAB_BYTES
from .textnum import scramble, slabs

SHINGLE, DISTANCE, SEED = 4, 4, 42
SEGMENTS = ((0, 23), (23, 23), (46, 18))
SLAB = 1 << 16


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= size:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - size + 1]
    ends = ends[size - 1 :]
    ones, h = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), SLAB):
        spans = zip(starts[at : at + SLAB].tolist(), ends[at : at + SLAB].tolist())
        hashes = np.array([h(joined[a:b], SEED) for a, b in spans], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """docs: doc_id, text. Adds fp (the fingerprint as a signed long) in place of text; other columns are kept."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column("text").cast(pa.large_binary())
            fps = np.fromiter((fingerprint(t.as_py() or b"", size) for t in texts), np.uint64, len(texts))
            rest = [k for k in batch.schema.names if k != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in rest), pa.array(fps.view(np.int64))], [*rest, "fp"])

    return docs.mapInArrow(run, f"{schema}, fp long")


def keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and keys: 33 a fingerprint at most."""
    rows, out = [], []
    words = [((fps.view(np.uint64) >> np.uint64(at)) & np.uint64((1 << bits) - 1)).astype(np.int64) for at, bits in SEGMENTS]
    near = [golay.near(w, bits) for w, (_, bits) in zip(words, SEGMENTS)]
    own = [golay.decode(w) for w in words]
    for pair, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
        for a, b, left in ((near[i], own[j], True), (near[j], own[i], False)):
            use = a >= 0
            if not left:
                use = use & (a != own[j][:, None])  # this key is among the others
            r, c = np.nonzero(use)
            x, y = (a[r, c], b[r]) if left else (b[r], a[r, c])
            rows.append(r)
            out.append((pair << 24) | (x << 12) | y)
    return np.concatenate(rows), np.concatenate(out)


def _key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seed, fps, node = (longs(batch.column(c)) for c in ("seed", "fp", "node"))
        for at in range(0, len(fps), 4096):
            part = np.ascontiguousarray(fps[at : at + 4096])
            r, k = keys(part)
            k |= seed[at : at + 4096][r].astype(np.int64) << 26
            yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(part[r]), pa.array(node[at : at + 4096][r])], ["k", "fp", "node"])


def forest(k: np.ndarray, fp: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """k sorted. Places of linked fingerprints, and of the first one in the tree of each among those with its key."""
    starts = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    sizes = np.diff(np.append(starts, len(k)))
    parent = np.arange(len(k))
    bits = fp.view(np.uint64)
    small = np.repeat(sizes <= 64, sizes)
    for step in range(1, min(64, int(sizes[sizes <= 64].max(initial=1)))):
        i = np.flatnonzero((k[step:] == k[:-step]) & small[step:])
        i = i[np.bitwise_count(bits[i] ^ bits[i + step]) <= distance]
        unite(parent, i + step, i)
    for a, n in zip(starts[sizes > 64].tolist(), sizes[sizes > 64].tolist()):
        for at in range(a, a + n, 512):
            i, j = np.nonzero(np.bitwise_count(bits[at : min(at + 512, a + n), None] ^ bits[None, at : a + n]) <= distance)
            unite(parent, i + at, j + at)
    root = flatten(parent)
    linked = np.flatnonzero(root != np.arange(len(k)))
    return linked, root[linked]


def _linker(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by key; a key's rows may spread over batches."""
        for t in _groups(batches):
            k, fp, node = (longs(t[c]) for c in ("k", "fp", "node"))
            a, b = forest(k, fp, distance)
            least = node.copy()  # a tree's smallest node, which many keys have in common, stands for it
            np.minimum.at(least, b, node[a])
            pairs = np.unique(np.concatenate([np.stack([node[x], least[b]], axis=1) for x in (a, b)]), axis=0)
            pairs = pairs[pairs[:, 0] != pairs[:, 1]]
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return run


def links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """fps: seed (0 to 31), fp, node; distinct. Links a, b of nodes that connect exactly those whose chain of links connects
    them; fingerprints of different seeds do not meet."""
    if not 0 <= distance <= DISTANCE:
        raise ValueError(f"the keys hold for up to {DISTANCE} bits")
    rows = fps.select("seed", "fp", "node").mapInArrow(_key_rows, "k int, fp long, node long")
    return rows.repartition(partitions(fps.sparkSession), "k").sortWithinPartitions("k", "fp").mapInArrow(_linker(distance), "a long, b long")


def groups(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """prints: fp and any columns. Returns fp, root: every distinct fingerprint with its component's."""
    fps = cut(prints.select("fp").distinct(), "fps", narrow=True)
    named = fps.select(F.lit(0).alias("seed"), "fp", F.col("fp").alias("node"))
    roots = components(links(named, distance)).withColumnRenamed("id", "fp")
    return fps.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def cluster(docs: DataFrame, size: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """docs: doc_id, text. Returns doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id)."""
    prints = cut(fingerprints(docs.select("doc_id", "text"), size), "prints")
    named = groups(prints, distance)
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least")).join(named, "fp")
    names = least.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = named.join(names, "root").select("fp", "component_id")
    return prints.join(by_fp, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: The pipeline's form: word-set fingerprints under several seeds, then an exact join of five-word shingles. Shingles that begin
#: more than COMMON texts (by a part of one in PART of them) are put last in the join's order (the FREQUENT most common ones at most).
SEEDS, SHINGLES, SIMILARITY = 5, 5, 0.8
COMMON, PART, FREQUENT = 16, 4, 1 << 18


def word_fingerprints(text: bytes, seeds: int = SEEDS) -> list[int]:
    """SimHashes of a text's distinct words under several seeds (as signed longs)."""
    words = set(text.lower().split())
    h = np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in words), np.uint64, len(words))
    out = np.zeros(seeds, "<u8")
    for k in range(seeds if words else 0):
        bits = np.unpackbits(scramble(h + np.uint64(k << 32)).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        out[k] = np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(h), bitorder="little").view("<u8")[0]
    return out.view(np.int64).tolist()


def shingles(text: bytes, size: int = SHINGLES) -> np.ndarray:
    """Sorted distinct hashes of the runs of so many words (of the whole, if it has fewer)."""
    words = text.lower().split()
    runs = {b" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))}
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, runs), np.uint64, len(runs)))


def keep_one(docs: DataFrame, seeds: int = SEEDS, least: float = SIMILARITY) -> DataFrame:
    """docs less its copies. Rows are linked whose five-word shingles have a Jaccard similarity of least or more; no two
    rows that stay are linked, and a row that goes is linked to one that stays, or to one that went for its sake. All columns stay.

    Of a group of equal texts the smallest doc_id stands for all. A first pass takes texts linked by any of several SimHashes of
    their distinct words, which edits of single words disturb less than shingles: in each such group those go that the exact
    comparison finds alike to the one nearest to the bitwise majority. What stays is joined exactly (see alike_to_others), whatever its fingerprints.
    The rows are written to the shared folder with a number each first, so that every later read has the same numbers.
    Texts without words are equal to each other; docs may have any columns but granary_uid."""
    own = cut(docs.withColumn("granary_uid", F.monotonically_increasing_id()), "docs")
    prints = cut(own.select("doc_id", "text", F.col("granary_uid").alias("uid")).mapInArrow(_word_prints(seeds), "uid long, doc_id long, same string, fps array<long>"), "prints")
    one = cut(
        prints.groupBy("same").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "uid")).alias("x"), F.first("fps").alias("fps")).select("same", "x.uid", "fps"),
        "texts",
        narrow=True,
    )
    prints_of = one.select("uid", F.posexplode("fps").alias("seed", "fp"))
    each = cut(prints_of.groupBy("seed", "fp").agg(F.min("uid").alias("node")), "fps", narrow=True)
    alike = prints_of.join(each, ["seed", "fp"]).where("node <> uid").select(F.col("node").alias("a"), F.col("uid").alias("b"))
    roots = cut(components(links(each).unionByName(alike)), "roots", narrow=True).withColumnRenamed("id", "uid")
    members = one.join(roots, "uid").select("uid", "root", "fps")
    places = [(k, b) for k in range(min(seeds, 2)) for b in range(64)]
    most = F.expr(f"array({', '.join(f'sum(shiftright(fps[{k}], {b}) & 1) * 2 > count(1)' for k, b in places)})")
    counts = members.groupBy("root").agg(most.alias("most"))
    away = F.expr("size(filter(most, (m, k) -> m <> ((shiftright(fps[k div 64], cast(k % 64 as int)) & 1) = 1)))")
    near = members.join(counts, "root").groupBy("root").agg(F.min(F.struct(away.alias("away"), "uid")).alias("x"))
    linked = cut(members.join(near.select("root", F.col("x.uid").alias("kept")), "root").select("uid", "root", "kept"), "linked", narrow=True)
    text = own.select("granary_uid", "text").join(linked.hint("shuffle_hash"), F.col("granary_uid") == linked["uid"]).select("uid", "root", "kept", "text")
    sets = cut(text.mapInArrow(_shingle_sets, "uid long, root long, kept long, set array<long>"), "sets")
    first = sets.where("uid = kept").select("root", F.col("set").alias("of"))
    common = F.size(F.array_intersect("set", "of"))
    gone = sets.where("uid <> kept").join(first, "root").where(common / (F.size("set") + F.size("of") - common) >= least).select("uid")
    copies = prints.join(one.select("same", F.col("uid").alias("kept")), "same").where("uid <> kept").select("uid")
    gone = cut(gone, "gone", narrow=True)
    stay = cut(one.select("uid").join(gone, "uid", "left_anti"), "stay", narrow=True)
    release(sets)
    near = alike_to_others(own.select(F.col("granary_uid").alias("uid"), "text"), stay, least)
    dropped = cut(gone.unionByName(copies).unionByName(near), "dropped", narrow=True)
    return own.join(dropped.hint("shuffle_hash"), own["granary_uid"] == dropped["uid"], "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


def _word_prints(seeds: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe.forget()  # an earlier run's encoder, if the worker is still there
        for batch in slices(batches):
            texts = [t or b"" for t in batch.column("text").cast(pa.large_binary()).to_pylist()]
            same = [xxhash.xxh3_128_hexdigest(b" ".join(t.lower().split())) for t in texts]
            fps = pa.array([word_fingerprints(t, seeds) for t in texts], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("uid"), batch.column("doc_id"), pa.array(same, pa.string()), fps], ["uid", "doc_id", "same", "fps"])

    return run


def _shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        sets = [shingles(t or b"").view(np.int64) for t in batch.column("text").cast(pa.large_binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("uid", "root", "kept")), pa.array(sets, pa.list_(pa.int64()))], ["uid", "root", "kept", "set"])


def alike_to_others(texts: DataFrame, stay: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """texts: uid, text, the same when read again; stay: the uids that are asked for. The uids to drop of these so that no two
    stay whose shingles are alike at least so much: of texts that such pairs connect the smallest uid stays. Exact: a prefix join
    with filters by length and by the count of common shingles.

    Put in any one order of all shingles, two such sets have shingles in common among the first
    n - ceil(least n) + 1 of each. Shingles that many prefixes of a part of the texts share are put last, so that a common line is in few
    prefixes. Groups of one shingle first meet three of their own texts only, which takes away most of any large group of copies; then all
    pairs of what is left are compared."""
    none = np.empty(0, np.uint64)
    part = texts.where(F.pmod(F.xxhash64("uid"), F.lit(PART)) == 0)
    first = part.mapInArrow(_prefixes(least, none, none.view(np.int64)), PREFIX).groupBy("k").agg(F.count("*").alias("m"))
    often = first.where(F.col("m") > COMMON // PART).orderBy(F.desc("m"), "k").limit(FREQUENT).toArrow()
    common, m = longs(often["k"]).view(np.uint64), longs(often["m"])
    order = np.argsort(common)
    shared = _shared(texts.mapInArrow(_prefixes(least, common[order], m[order]), PREFIX))
    rows = cut(shared.join(stay, "uid").select("k", "uid", "n"), "asked", narrow=True)
    release(shared)
    near = _gone(texts, rows, least, pivots=True)
    return near.unionByName(_gone(texts, rows.join(near, "uid", "left_anti").select("k", "uid", "n"), least, pivots=False))


PREFIX = "k long, uid long, n int"


def _shared(rows: DataFrame) -> DataFrame:
    """The rows whose shingle is in other rows too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches):
            k = longs(t["k"])
            again = np.concatenate([[False], k[1:] == k[:-1], [False]])
            yield from t.filter(pa.array(again[1:] | again[:-1])).combine_chunks().to_batches()

    return cut(_by_key(rows).mapInArrow(run, PREFIX), "shared", narrow=True)


def _by_key(rows: DataFrame) -> DataFrame:
    return rows.repartition(partitions(rows.sparkSession), "k").sortWithinPartitions("k", "n", "uid")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole groups; rows come sorted by k. Batches are put together once, when a group is whole."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        k = longs(batch.column("k"))
        upto = int(np.searchsorted(k, k[-1]))  # the batch's last group may go on
        if upto or (held and held[-1].column("k")[-1].as_py() != k[-1]):
            whole = [*held, batch.slice(0, upto)]
            yield pa.Table.from_batches([b for b in whole if b.num_rows]).combine_chunks()
            held = []
        held.append(batch.slice(upto))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _need(n: np.ndarray, m: np.ndarray, least: float) -> np.ndarray:
    """How many shingles sets of n and m must have in common."""
    return np.ceil(least / (1 + least) * (n + m) - 1e-6)


def _rest(n: np.ndarray, least: float) -> np.ndarray:
    """How many shingles of a set of n are not in its prefix."""
    return np.ceil(least * n - 1e-6) - 1


def _gone(texts: DataFrame, rows: DataFrame, least: float, pivots: bool) -> DataFrame:
    """pivots: a group's texts meet three of their own only. Otherwise all pairs are compared: those of groups of FEW texts or fewer one by one,
    those of larger groups in pages (see _paged)."""
    most = FEW

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches):
            k, uid, n = (longs(t[c]) for c in ("k", "uid", "n"))
            start = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
            size = np.diff(np.append(start, len(k)))
            base, span = np.repeat(start, size), np.repeat(size, size)
            i = np.arange(len(k))
            if pivots:
                steps = [(i, base), (i[span > 2], (base + span // 2)[span > 2]), (i[span > 1], (base + span - 1)[span > 1])]
            else:
                few = span <= most
                near = lambda s: few[s:] & (k[s:] == k[:-s])
                steps = ((i[s:][near(s)], i[:-s][near(s)]) for s in range(1, int(size[size <= most].max(initial=1))))
                yield _pairs(uid[~few], np.minimum.reduceat(uid, start)[np.repeat(np.arange(len(size)), size)][~few], np.zeros((~few).sum()))
            for a, b in steps:
                need = _common(n[a], n[b], least)
                use = (need > 0) & (uid[a] != uid[b])
                if use.any():
                    a, b = a[use], b[use]
                    yield _pairs(np.minimum(uid[a], uid[b]), np.maximum(uid[a], uid[b]), need[use])

    met = cut(_by_key(rows).mapInArrow(run, "a long, b long, m int"), "met", narrow=True)
    counted = met.where("m > 0").groupBy("a", "b", "m").agg(F.count("*").alias("c"))
    enough = F.col("c") * 2 >= F.col("m") if pivots else F.col("c") >= F.col("m")  # pivots see only some of the common shingles
    pairs = cut(counted.where(enough).select("a", "b"), "pairs", narrow=True)
    asked = pairs.select(F.col("a").alias("u")).unionByName(pairs.select(F.col("b").alias("u"))).distinct()
    own = texts.join(asked.hint("shuffle_hash"), texts["uid"] == asked["u"]).select("uid", F.lit(0).cast("long").alias("root"), F.lit(0).cast("long").alias("kept"), "text")
    sets = cut(own.mapInArrow(_shingle_sets, "uid long, root long, kept long, set array<long>"), "sets")
    one, two = (sets.select(F.col("uid").alias(c), F.col("set").alias(s)) for c, s in (("a", "x"), ("b", "y")))
    common = F.size(F.array_intersect("x", "y"))
    same = pairs.join(one, "a").join(two, "b").where(common / (F.size("x") + F.size("y") - common) >= least).select("a", "b")
    if not pivots:
        same = same.unionByName(_paged(texts, met.where("m = 0").select("a", "b"), least))
    gone = cut(components(same).where("id <> root").select(F.col("id").alias("uid")).distinct(), "near", narrow=True)
    release(met, pairs, sets)
    return gone


def _pairs(a: np.ndarray, b: np.ndarray, m: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(m.astype(np.int32))], ["a", "b", "m"])


def _common(n: np.ndarray, m: np.ndarray, least: float) -> np.ndarray:
    """How many shingles the prefixes of alike sets of n and m have in common at least: all but what the rest of the set whose prefix
    ends first can hold. 0 where sets of such sizes cannot be alike."""
    need = _need(n, m, least)
    return np.where(np.minimum(n, m) >= need, np.maximum(1, need - np.maximum(_rest(n, least), _rest(m, least))), 0)


#: Texts of a group whose pairs are written one by one, of a page in larger ones, and shingles that are counted at once there.
FEW, PAGE, WIDE = 32, 256, 4096
#: Texts of a page of sketches, and eight-byte words of them that are compared at once.
SKETCHES, WORDS = 2048, 1 << 21


def _paged(texts: DataFrame, links: DataFrame, least: float) -> DataFrame:
    """links: each text of a large group with the group's first. Of the texts that large groups connect, links a, b that connect just those whose
    shingles are alike. Many groups that share a few texts each hang together though hardly any of their texts are alike, so sketches
    tell first which may be (see _sketched). What these connect is dealt to pages; every two pages meet in a task, which compares their sets
    exactly and gives a forest, never pairs. A text is sent once for each page, so no group, however large, is in one task."""
    chained = cut(components(links).withColumnRenamed("id", "u"), "chained", narrow=True)
    if chained.isEmpty():
        return links
    roots = cut(components(_sketched(texts, chained, least)).withColumnRenamed("id", "u"), "large", narrow=True)
    release(chained)
    if roots.isEmpty():
        return roots.select(F.col("u").alias("a"), F.col("root").alias("b"))
    own = texts.join(roots.hint("shuffle_hash"), texts["uid"] == roots["u"]).select("uid", "root", F.lit(0).cast("long").alias("kept"), "text")
    dealt = _dealt(cut(own.mapInArrow(_shingle_sets, "uid long, root long, kept long, set array<long>"), "large-sets"), roots, PAGE, "set")
    at_once = WIDE

    def run(t: pa.Table) -> pa.Table:
        uid, lists = longs(t["uid"]), t["set"].combine_chunks()
        n = np.diff(lists.offsets.to_numpy())
        k, row = lists.flatten().to_numpy(), np.repeat(np.arange(len(uid)), n)
        _, column, times = np.unique(k, return_inverse=True, return_counts=True)
        shared = times[column] > 1
        column, row = (np.cumsum(times > 1) - 1)[column[shared]], row[shared]
        order = np.argsort(column, kind="stable")
        column, row = column[order], row[order]
        common = np.zeros((len(uid), len(uid)), np.float32)  # whole numbers
        for at in range(0, int((times > 1).sum()), at_once):
            a, b = np.searchsorted(column, [at, at + at_once])
            block = np.zeros((len(uid), at_once), np.float32)
            block[row[a:b], column[a:b] - at] = 1
            common += block @ block.T
        i, j = np.nonzero(np.triu(common >= least * (n[:, None] + n - common), 1))
        parent = np.arange(len(uid))
        unite(parent, i, j)
        root = flatten(parent)
        linked = np.flatnonzero(root != np.arange(len(uid)))
        return pa.table({"a": uid[linked], "b": uid[root[linked]]})

    return dealt.groupBy("root", "left", "right").applyInArrow(run, "a long, b long")


def _dealt(rows: DataFrame, roots: DataFrame, size: int, *cols: str) -> DataFrame:
    """rows: uid, root and cols. Each row once for every page of its root's, with the two pages that meet (left, right) and its own."""
    pages = roots.groupBy("root").agg(F.ceil(F.count("*") / size).cast("int").alias("pages"))
    own, other = F.col("own"), F.col("other")
    return (
        rows.join(pages, "root")
        .withColumn("own", F.pmod(F.xxhash64("uid"), F.col("pages")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pages") - 1)))
        .select("root", F.least(own, other).alias("left"), F.greatest(own, other).alias("right"), "own", "uid", *cols)
    )


def _sketched(texts: DataFrame, chained: DataFrame, least: float) -> DataFrame:
    """chained: u, root. Links a, b that connect at least those of a root's texts whose shingles are alike. A sketch has a bit for whether an odd
    number of shingles fall on its place, so two differ in no more bits than their sets differ in shingles: no alike pair is lost. Sketches
    have two to four bits a shingle, and pairs whose sets are not nearly alike differ in more bits than alike sets can."""
    own = texts.join(chained.hint("shuffle_hash"), texts["uid"] == chained["u"]).select("uid", "root", "text")
    rows = cut(own.mapInArrow(_sketches, "uid long, root long, n int, bits array<long>"), "sketches")

    def run(t: pa.Table) -> pa.Table:
        uid, n, own = (longs(t[c]) for c in ("uid", "n", "own"))
        parent = np.arange(len(uid))
        for i, j in sketch_pairs(n, t["bits"].combine_chunks(), least):
            meet = (own[i] != own[j]) | (t["left"][0] == t["right"][0])  # a page's own pairs meet where it is alone
            unite(parent, i[meet], j[meet])
        root = flatten(parent)
        linked = np.flatnonzero(root != np.arange(len(uid)))
        return pa.table({"a": uid[linked], "b": uid[root[linked]]})

    return _dealt(rows, chained, SKETCHES, "n", "bits").groupBy("root", "left", "right").applyInArrow(run, "a long, b long")


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        d, k = shingle_rows([t or b"" for t in batch.column("text").cast(pa.large_binary()).to_pylist()])
        n = np.bincount(d, minlength=batch.num_rows)
        bits = sketches(d, k, n)
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("uid", "root")), pa.array(n.astype(np.int32)), bits], ["uid", "root", "n", "bits"])


def sketches(d: np.ndarray, k: np.ndarray, n: np.ndarray) -> pa.ListArray:
    """d, k: a set's number and a shingle of it; n: the sets' sizes. Parities of the shingles by their last bits, in 2 n bits or up to twice as many."""
    wide = 1 << np.ceil(np.log2(np.maximum(1, n / 32))).astype(np.int64)  # words of 64 bits
    at = np.concatenate([[0], np.cumsum(wide)])
    place = at[:-1][d] * 64 + (k & (64 * wide[d] - 1).astype(np.uint64)).astype(np.int64)
    odd = (np.bincount(place, minlength=at[-1] * 64) & 1).astype(np.uint8)
    return pa.ListArray.from_arrays(at.astype(np.int32), pa.array(np.packbits(odd, bitorder="little").view(np.int64)))


def sketch_pairs(n: np.ndarray, bits: pa.ListArray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of sets of n shingles whose sizes and sketches allow them to be alike. Of sketches of two widths the wider is folded; a set with one of
    over twice the width is too large to be alike."""
    at, flat = bits.offsets.to_numpy(), bits.values.to_numpy().view(np.uint64)
    wide = np.diff(at)
    order = np.argsort(n, kind="stable")
    rows = lambda w: order[wide[order] == w]
    grid = lambda x, w: flat[at[x][:, None] + np.arange(w)]
    for w in np.unique(wide).tolist():
        one, two = rows(w), rows(2 * w)
        both = np.concatenate([one, two])
        a, m = grid(one, w), n[both]
        b = np.concatenate([a, np.bitwise_xor.reduce(grid(two, 2 * w).reshape(-1, 2, w), axis=1)])
        step = max(1, WORDS // (w * len(both)))
        for lo in range(0, len(one), step):
            hi = min(lo + step, len(one))
            end = int(np.searchsorted(m, m[hi - 1] / least + 1e-6, side="right"))
            differ = np.bitwise_count(a[lo:hi, None] ^ b[None, lo:end]).sum(axis=2, dtype=np.int64)
            x, y = m[lo:hi, None], m[None, lo:end]
            i, j = np.nonzero(np.triu(differ <= x + y - 2 * _need(x, y, least), 1))
            yield one[i + lo], both[j + lo]


def shingle_rows(texts: list[bytes], size: int = SHINGLES) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles' hashes of each text that has so many words, and the text's number; in order of text and hash."""
    docs, runs = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for s in slabs(texts, size=max(SLAB_BYTES, max(map(len, texts), default=0) + 1)):  # no text is cut
        h, d = s.hashes(), s.doc
        if len(h) < size:
            continue
        run = h[: len(h) - size + 1]
        for k in range(1, size):
            run = scramble(run + h[k : len(h) - size + 1 + k])
        whole = d[size - 1 :] == d[: len(d) - size + 1]
        run, d = run[whole], d[: len(d) - size + 1][whole]
        order = np.lexsort((run, d))
        run, d = run[order], d[order]
        fresh = np.ones(len(d), bool)
        fresh[1:] = (run[1:] != run[:-1]) | (d[1:] != d[:-1])
        docs.append(d[fresh])
        runs.append(run[fresh])
    return np.concatenate(docs), np.concatenate(runs)


def _prefixes(least: float, common: np.ndarray, often: np.ndarray):
    """common: sorted hashes of shingles that come last, the most often found ones at the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            d, k = shingle_rows([t or b"" for t in batch.column("text").cast(pa.large_binary()).to_pylist()])
            if len(common):
                i = np.minimum(np.searchsorted(common, k), len(common) - 1)
                late = np.where(common[i] == k, often[i], 0)
                if late.any():
                    order = np.lexsort((k, late, d))
                    k = k[order]
            n = np.bincount(d, minlength=batch.num_rows)
            at = np.arange(len(d)) - (np.cumsum(n) - n)[d]
            use = at <= (n - np.ceil(least * n - 1e-6))[d]
            d, k = d[use], k[use]
            uid = longs(batch.column("uid"))[d]
            yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(uid), pa.array(n[d].astype(np.int32))], ["k", "uid", "n"])

    return run
