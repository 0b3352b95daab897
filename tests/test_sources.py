import math
import uuid
from datetime import UTC, datetime, timedelta
from pathlib import Path

import pytest

from granary.operators import profile
from granary.operators.rules import Rule
from granary.plans import readiness, release
from granary.sources import delimited, publish, schema, store, tables
from granary.streaming import monitor

from .conftest import DATA


def test_delimited(spark, tmp_path):
    f = tmp_path / "a.csv"
    f.write_text('id ; note\n1;"a;b"\n2;\n', encoding="utf-8")
    assert delimited.sniff(spark, str(f)) == ";"
    df = delimited.read(spark, str(f))
    assert df.columns == ["id", "note"] and [tuple(r) for r in df.collect()] == [("1", "a;b"), ("2", "")]
    (tmp_path / "b.csv").write_bytes(b"id\n\xff\n")
    assert [(r.bytes, r.at) for r in delimited.undecodable(spark, str(tmp_path)).collect()] == [(5, 3)]
    (tmp_path / "c.csv").write_bytes("id;ad\r\n1;İğ\r\n".encode("cp1254"))
    (tmp_path / "d.csv").write_bytes(b"")
    turkish = delimited.read(spark, str(tmp_path / "c.csv"), encoding="cp1254")
    assert turkish.columns == ["id", "ad"] and [tuple(r) for r in turkish.collect()] == [("1", "İğ")]
    assert delimited.undecodable(spark, str(tmp_path / "c.csv"), "cp1254").count() == 0
    bad = {r.path[-5:]: (r.at, r.reason) for r in delimited.undecodable(spark, str(tmp_path)).collect()}
    assert bad["c.csv"][0] == 9 and set(bad) == {"b.csv", "c.csv"}
    none = delimited.read(spark, str(tmp_path / "d.csv"))
    assert none.columns == [] and none.count() == 0
    for wrong, error in (("no such encoding", LookupError), ("cp500", ValueError)):
        with pytest.raises(error):
            delimited.read(spark, str(tmp_path / "c.csv"), encoding=wrong)


def test_publish(spark, tmp_path):
    df = spark.createDataFrame([("1",), ("2",), ("x",)], "v string")
    rule = Rule("n", "is_numeric", {"column": "v"})
    with pytest.raises(publish.Withheld):
        publish.publish(df, [rule], f"file://{tmp_path}/t", f"file://{tmp_path}/q", least_rate=0.9)
    assert list(tmp_path.iterdir()) == []
    got = publish.publish(df, [rule], f"file://{tmp_path}/t", f"file://{tmp_path}/q", least_rate=0.5)
    assert (got.published, got.quarantined) == (2, 1) and math.isclose(got.hold_rates["n"], 2 / 3)
    assert sorted(r.v for r in spark.read.parquet(f"{tmp_path}/t").collect()) == ["1", "2"]
    assert [tuple(r) for r in spark.read.parquet(f"{tmp_path}/q").collect()] == [("x", ["n"])]
    assert {p.name for p in tmp_path.iterdir()} == {"t", "q"}
    with pytest.raises(FileExistsError):
        publish.publish(df, [rule], f"file://{tmp_path}/t", f"file://{tmp_path}/q2")


def test_jdbc(spark, tmp_path):
    """Derby comes with Spark."""
    options = {"url": f"jdbc:derby:{tmp_path}/db;create=true", "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    source = tables.Source("jdbc", ("regions",), options)
    df = spark.read.parquet(f"{DATA}/region.parquet")
    tables.write(df, source)
    back = tables.read(spark, source).toDF("r_regionkey", "r_name")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_stream_by_declaration(spark, tmp_path):
    events = spark.read.parquet(f"{DATA}/events.parquet")
    events.repartition(3).write.json(f"{tmp_path}/in")
    source = tables.Source("json", (f"{tmp_path}/in",))
    stream = tables.read_stream(spark, source, events.schema, files_at_once=1)
    tables.write_stream(stream, tables.Source("parquet", (f"{tmp_path}/out",)), f"{tmp_path}/cp", once=True).awaitTermination(120)
    assert spark.read.parquet(f"{tmp_path}/out").count() == events.count()
    with pytest.raises(ValueError):
        tables.read_stream(spark, tables.Source("jdbc", ("t",)), events.schema)


def test_ids_sort_by_time():
    ids = [store.new_id(datetime(2026, 1, 1, tzinfo=UTC) + timedelta(seconds=k)) for k in range(5)]
    assert ids == sorted(ids) and all(uuid.UUID(i).version == 7 and uuid.UUID(i).variant == uuid.RFC_4122 for i in ids)


def test_profiles_share_a_scan(spark):
    df = spark.createDataFrame([(1, "a", None), (1, None, [1]), (2, "a", [1])], "k int, v string, l array<int>")
    got = {r.column_name: (r["rows"], r.nulls, r.distinct_values) for r in profile.columns(df, ("k", "v", "l")).collect()}
    assert got == {"k": (3, 0, 2), "v": (3, 1, 1), "l": (3, 1, 1)}
    assert [tuple(r) for r in profile.columns(df.limit(0), ("k",)).collect()] == [("k", 0, 0, 0, None)]
    keys = {r.combination: (r.distinct_rows, r.is_key) for r in profile.unique_combinations(df, (("k",), ("v",), ("k", "v"))).collect()}
    assert keys == {"k": (2, False), "v": (2, False), "k,v": (3, True)}
    series = spark.createDataFrame([("x", 1, 1), ("x", 1, 2), ("x", 2, 5), ("y", 1, 7)], "s string, p int, m int")
    base = {(r.s, r.p): (r.m, r["mean"]) for r in profile.baseline(series, "p", "m", series=["s"]).collect()}
    assert base == {("x", 1): (3, None), ("x", 2): (5, 3.0), ("y", 1): (7, None)}


def test_store_finds_tampering(spark, tmp_path):
    df = spark.read.parquet(f"{DATA}/nation.parquet")
    record = store.write(df, f"file://{tmp_path}", "test")
    assert store.Record.from_json(record.to_json()) == record
    run = store.Run("r").add(record)
    assert sorted(run.read(spark, record.id).collect()) == sorted(df.collect())
    assert store.logical_digest(df.repartition(3)) == record.logical_digest
    with pytest.raises(KeyError):
        run.read(spark, "other")
    with pytest.raises(ValueError):
        run.add(record)
    part = next(Path(record.uri.removeprefix("file:")).glob("**/*.parquet"))
    part.write_bytes(part.read_bytes()[:-1] + b"x")
    part.with_name(f".{part.name}.crc").unlink()  # the local file system's own check
    with pytest.raises(store.Tampered):
        run.read(spark, record.id)


def test_readiness(spark):
    df = spark.createDataFrame([("1", "2026-01-01T00:00:00Z"), ("1", "x")], "id string, at string")
    contract = readiness.Contract(("id", "at"), ("id",), least_rows=3, instant="at", fresh_hours=1)
    got = {r.check: r.status for r in readiness.judge(df, contract, datetime(2026, 1, 1, 2, tzinfo=UTC)).collect()}
    assert got == {"columns present": "passed", "rows within bounds": "failed", "fresh": "failed", "key complete and unique": "failed"}
    lacking = readiness.judge(df.drop("at"), contract, datetime(2026, 1, 1, tzinfo=UTC)).collect()
    assert lacking[0].status == "failed" and lacking[0].observed == "at"


def test_release(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 4, "v string")
    assert profile.safe_values(df, "v", 4).count() == 2
    with pytest.raises(release.Refused):
        release.column_values(df, "v", release.Policy(frozenset({"v"})))
    with pytest.raises(release.Refused):
        release.column_values(df, "v", release.Policy(frozenset({"v"}), frozenset({"v"}), k=1))
    assert release.column_values(df, "v", release.Policy(frozenset({"v"}), k=4)) == [("a", 5), ("b", 4)]
    for bad in (("rate", 1.5), ("count", True), ("identifier", "a b"), ("time", datetime(2026, 1, 1)), ("text", "x"), ("digest", "0" * 63), ("mask", "A-9b")):
        with pytest.raises(release.Refused):
            release.document({"f": bad})
    assert release.document({"n": ("count", 3)}) == '{\n  "n": 3\n}\n'


def test_stream(spark, tmp_path):
    src = tmp_path / "in"
    spark.read.parquet(f"{DATA}/events.parquet").write.parquet(str(src))
    stream = spark.readStream.schema(spark.read.parquet(str(src)).schema).parquet(str(src))
    rule = Rule("v", "in_range", {"column": "value", "least": 0, "most": 100})
    q = monitor.windowed(stream, [rule], "ts").writeStream.outputMode("complete").format("memory").queryName("seen").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    want = monitor.windowed(spark.read.parquet(str(src)), [rule], "ts")
    assert sorted(spark.table("seen").collect()) == sorted(want.collect())


def test_schema(spark, tmp_path):
    from granary.catalogue import ORDERS

    df = spark.createDataFrame([(1, 2)], "a int, b int")
    b = schema.bind(df, ORDERS, {"a": "order_id", "c": "no such field"})
    assert not b.fits and b.unknown_fields == ("no such field",) and b.lacking_columns == ("c",) and b.unmet == ("customer",)
    with pytest.raises(ValueError):
        schema.apply(df, b)
    for bad in ({"fields": []}, {"key": ["x"]}, {"more": 1}, {"instant": "x"}):
        with pytest.raises(ValueError):
            schema.Schema.from_dict({"id": "s", "key": ["k"], "fields": [{"name": "k", "meaning": "code"}]} | bad)
    f = tmp_path / "s.json"
    f.write_text('{"id": "s", "key": ["k"], "fields": [{"name": "k", "meaning": "phone"}]}')
    assert schema.load([f])["s"].fields[0].personal
    with pytest.raises(ValueError):
        schema.load([f, f])
    assert schema.resolve([f], "s").key == ("k",)
    for paths, error in (([], schema.Unknown), ([f, f], schema.Ambiguous)):
        with pytest.raises(error):
            schema.resolve(paths, "s")


def test_source_declarations(spark):
    for bad in (("avro2", ("x",), {}), ("csv", (), {}), ("csv", ("ftp://h/x",), {}), ("jdbc", ("t",), {"password": "stated"})):
        with pytest.raises(ValueError):
            tables.Source(bad[0], bad[1], {}, bad[2])
    with pytest.raises(KeyError):
        tables.read(spark, tables.Source("jdbc", ("t",), {}, {"password": "env:NOT_SET"}), {})


def test_patterns(spark):
    cases = {
        "rfc3339_instant": (["2024-01-01T10:00:00Z", "2024-01-01t10:00:60.5+02:00"], ["10:00", "2024-01-01", "2024-01-01T10:00:00Z\n", "2024-01-01T10:00Z", "2024-13-01T10:00:00Z", "2024-01-01T24:00:00Z", None]),
        "html_email": (["a.b+c@d-e.org", "x@localhost"], ["a@", "@b", "a b@c", "a@-b.c", "a@b..c", "a@b\n", "é@b.c"]),
        "uuid": (["0190163d-8694-739b-aea5-966c26f8ad91"], ["0190163d8694739baea5966c26f8ad91", ""]),
        "e164": (["+905551112233"], ["905551112233", "+0123", "+1234567890123456"]),
    }
    for name, (good, bad) in cases.items():
        df = spark.createDataFrame([(v,) for v in good + bad], "v string")
        got = [r.holds for r in df.coalesce(1).select(Rule("p", "matches", {"column": "v", "pattern": name}).holds().alias("holds")).collect()]
        assert got == [True] * len(good) + [False] * len(bad), name
