import hashlib
from collections import Counter

import corpus_pipeline as pipeline
from granary.llm import common, mixing
from granary.llm.common import cut

from ..conftest import DATA


def test_stages(spark):
    docs = first = spark.read.parquet(f"{DATA}/documents.parquet")
    for k, (_, stage) in enumerate(pipeline.STAGES[:-1]):
        after = cut(stage(spark, docs, DATA))
        assert after.columns == first.columns and after.count() <= docs.count()
        assert after.count() == docs.count() or k < 2  # only the first two drop documents
        docs = after
    out = {r.doc_id: r for r in pipeline.STAGES[-1][1](spark, docs, DATA).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert out.keys() == texts.keys()
    assert all(out[k].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest() and out[k].n_tokens == len(out[k].ids) for k, t in texts.items())
    good = spark.read.parquet(f"{DATA}/labels.parquet").where("quality = 1")
    kept = stage_one(spark).select("doc_id")
    assert good.join(kept, "doc_id", "left_anti").join(first, "doc_id").count() == 0


def stage_one(spark):
    return pipeline.STAGES[0][1](spark, spark.read.parquet(f"{DATA}/documents.parquet"), DATA)


def test_result_keeps_the_shares_of_the_mix(spark, tmp_path):
    """Any number of rows from the start has each source's share to less than a block, however the result's files are read."""
    names = [*(f"src{k}" for k in range(20)), "elsewhere"]
    rows = spark.range(4000).selectExpr("id as doc_id", f"element_at(array({', '.join(map(repr, names))}), cast(id % 21 as int) + 1) as source", "concat('text ', id) as text")
    mixed = cut(pipeline.STAGES[3][1](spark, rows.repartition(6), DATA))
    pipeline.STAGES[4][1](spark, mixed, DATA).write.parquet(f"{tmp_path}/out")
    got = sorted(spark.read.parquet(f"{tmp_path}/out").select("mix_position", "source").collect())
    assert [r.mix_position for r in got] == list(range(4000))
    weights, have = {**mixing.WEIGHTS, "elsewhere": mixing.OTHER_WEIGHT}, Counter(r.source for r in got)
    seen = Counter()
    for n, r in enumerate(got[: 32 * 40], 1):  # before the first source runs out
        seen[r.source] += 1
        if n % mixing.BLOCK == 0:
            assert all(abs(seen[s] - n * w / 100) < mixing.BLOCK for s, w in weights.items())
    assert seen["src0"] < have["src0"]


def odd_documents(spark):
    """Nulls in any column, texts without words, very long ones, repeated rows, and extra columns of the names that operators use inside."""
    words = [f"w{k % 97}x{k // 7 % 89}" for k in range(60_000)]
    passage = " ".join(f"shared{k}" for k in range(60))
    texts = [None, "", " \n", "One.", " ".join(words), passage + " before " + " ".join(words[:300]), "Here " + " ".join(words[300:700]) + " then " + passage, "x" * 70_000]
    rows = [(k, t, "en", f"src{k % 2}" if k % 3 else None, k, "t", 1.5, None) for k, t in enumerate(texts)]
    rows += [rows[6], rows[0], (None, None, None, None, None, None, None, None), (None, "lost id. " + " ".join(words[900:1000]), None, "new", 9, "u", 0.0, [1])]
    kind = "doc_id long, text string, lang string, source string, n_chars long, t string, score double, spans array<int>"
    return spark.createDataFrame(rows, kind).repartition(3)


def test_odd_documents_go_through_all_stages(spark):
    docs = first = cut(odd_documents(spark))
    seen = []
    for _, stage in pipeline.STAGES[:-1]:
        after = cut(stage(spark, docs, DATA))
        assert after.schema == first.schema
        before, got = ({(r.doc_id, r.source, r.t) for r in x.collect()} for x in (docs, after))
        assert got <= before
        seen.append(after.count())
        docs = after
    assert seen[1] == seen[2] == seen[3] > 0
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all("shared3" not in (t or "") for t in texts.values())  # the shared passage is gone from both
    assert all(r.n_chars == len(r.text) for r in docs.collect() if r.text is not None and r.doc_id is not None)
    out = pipeline.STAGES[-1][1](spark, docs, DATA)
    assert out.columns == ["doc_id", "source", "mix_position", "n_tokens", "ids", "decoded_sha256"]
    rows = out.collect()
    assert sorted(r.mix_position for r in rows) == list(range(len(rows))) and len(rows) == seen[3]
    assert Counter(r.decoded_sha256 for r in rows) == Counter(hashlib.sha256((r.text or "").encode()).hexdigest() for r in docs.collect())


def test_an_empty_table_goes_through_all_stages(spark):
    docs = odd_documents(spark).limit(0)
    for _, stage in pipeline.STAGES[:-1]:
        docs = cut(stage(spark, docs, DATA))
        assert docs.columns == odd_documents(spark).columns and docs.count() == 0
    assert pipeline.STAGES[-1][1](spark, docs, DATA).count() == 0


def test_a_stage_deletes_what_the_stages_before_have_left(spark, tmp_path, monkeypatch):
    """Tables as large as the documents must not add up over the stages; what docs read themselves stays."""
    spark = spark.newSession()
    monkeypatch.setattr(common, "shared_dir", lambda spark: f"file://{tmp_path}/shared")
    tables = lambda kind: [p for p in (tmp_path / "shared").glob(f"granary-{kind}-*") if any(p.iterdir())]
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(200)
    for k, (_, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, docs, "some folder")
        if k:
            out.write.parquet(f"{tmp_path}/{k}")
            docs = spark.read.parquet(f"{tmp_path}/{k}")
        else:
            docs = out  # not written
        left = {kind: len(tables(kind)) for kind in ("docs", "rows", "mix")}
        assert left == [dict(docs=a, rows=b, mix=c) for a, b, c in ((0, 0, 0), (1, 0, 0), (0, 1, 0), (0, 0, 1), (0, 0, 1))][k]
    assert docs.count() > 0
    first = pipeline.STAGES[1][1](spark, spark.read.parquet(f"{DATA}/documents.parquet"), "another")
    pipeline.STAGES[2][1](spark, first, "another").collect()  # reads the first one's tables, though it was not written
    pipeline.STAGES[2][1](spark, first, "a third")
    assert first.count() > 0
