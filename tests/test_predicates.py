"""Row predicates are total: true or false for whatever a column holds."""

import math
import re

import pytest
from pyspark.sql import functions as F

from granary.operators.predicates import PREDICATES
from granary.operators.rules import Rule, repair, split, summarise, unbound, undo

HOSTILE = [None, "", "   ", "0", "-1", "1.5", "1d", "0x1p3", "NaN", "Infinity", "1_000", "٣٤٥", "12\n", " 12\t", "N/A", "2024-02-30", "2024-02-29", "2024-2-3", " "]
PARAMS = {
    "is_missing": {"column": "v", "blank_is_missing": True},
    "is_present": {"column": "v", "blank_is_missing": False},
    "matches": {"column": "v", "pattern": "xsd_integer"},
    "length_between": {"column": "v", "least": 1, "most": 3},
    "in_set": {"column": "v", "values": ["0", None]},
    "is_numeric": {"column": "v"},
    "in_range": {"column": "v", "least": 0, "most": 20},
    "has_checksum": {"column": "v", "scheme": "luhn"},
    "is_iso_date": {"column": "v"},
    "not_after": {"left": "v", "right": "w", "missing": "pass", "blank_is_missing": False},
    "equal": {"left": "v", "right": "w", "missing": "fail", "blank_is_missing": True},
}
TRUE = {
    "is_null": {None, "", "   ", " "},
    "is_present": set(HOSTILE) - {None},
    "matches": {"0", "-1"},
    "in_set": {None, "0"},
    "is_numeric": {"0", "-1", "1.5", "12\n", " 12\t"},
    "in_range": {"0", "1.5", "12\n", " 12\t"},
    "is_iso_date": {"2024-02-29"},
    "equal": set(),
}


@pytest.mark.parametrize("name", PARAMS)
def test_total(spark, name):
    df = spark.createDataFrame([(v, None) for v in HOSTILE], "v string, w string")
    got = {r.v: r.holds for r in df.select("v", Rule("r", name, PARAMS[name]).holds().alias("holds")).collect()}
    assert set(got.values()) <= {True, False}
    fails = {r.v: r.fails for r in df.select("v", Rule("r", name, PARAMS[name]).fails().alias("fails")).collect()}
    assert all(fails[v] is not got[v] for v in got)
    if name in TRUE:
        assert {v for v, holds in got.items() if holds} == TRUE[name]


def test_every_predicate_is_covered():
    assert {p for p in PREDICATES if PREDICATES[p].build} == set(PARAMS)


def test_params_are_checked():
    for params, error in (({}, ValueError), ({"column": "v", "least": 1, "most": True}, TypeError), ({"column": "v", "least": 0, "most": 1, "x": 1}, ValueError)):
        with pytest.raises(error):
            Rule("r", "length_between", params)
    with pytest.raises(ValueError):
        Rule("r", "no such predicate")
    with pytest.raises(ValueError):
        Rule("r", "is_numeric", {"column": "v"}, found_by="profile")
    for name, params in (("matches", {"column": "v", "pattern": ".*"}), ("has_checksum", {"column": "v", "scheme": "md5"}), ("unique_key", {"columns": [], "missing": "fail", "blank_is_missing": True}), ("equal", PARAMS["equal"] | {"missing": "maybe"})):
        with pytest.raises(ValueError):
            Rule("r", name, params)


NUMBERS = [None, 0.0, -0.0, 1.5, 2.0, 48.0, 48.5, float("nan"), float("inf"), float("-inf")]


@pytest.mark.parametrize("kind", ["double", "float", "int", "decimal(10,2)"])
def test_numbers_are_compared_as_numbers(spark, kind):
    values = [v for v in NUMBERS if kind in ("double", "float") or v is None or math.isfinite(v)]
    df = spark.createDataFrame([(v,) for v in values], "v double").select(F.col("v").cast(kind).alias("v"))
    types = dict(df.dtypes)
    rule, number = Rule("r", "in_range", {"column": "v", "least": 0, "most": 48}), Rule("n", "is_numeric", {"column": "v"})
    got = df.select("v", rule.holds(types).alias("typed"), rule.holds().alias("plain"), rule.fails(types).alias("fails"), number.holds(types).alias("n"), number.holds().alias("m")).collect()
    assert all(r.typed == r.plain and r.fails is not r.typed and r.n == r.m for r in got), got


def test_rules_reach_the_scan(spark):
    from granary import catalogue

    from .conftest import DATA

    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    df = spark.read.parquet(f"{DATA}/lineitem.parquet")
    good, bad = split(df, catalogue.LINE_RULES[:3])
    for part in (good, bad):
        pushed = re.search(r"PushedFilters: \[([^\n]*)", plan(part))[1]
        assert all(c in pushed for c in ("l_quantity", "l_discount", "l_returnflag")), pushed
    assert good.count() + bad.count() == df.count()
    scans = lambda name: plan(catalogue.QUERIES[name](spark, DATA)).count("FileScan")
    assert scans("set_rules") <= 4 and scans("profile_columns") == 1 and scans("unique_combinations") == 1 and scans("rule_summary_flagship") == 2
    assert plan(catalogue.QUERIES["p_checksum"](spark, DATA)).count("regexp_") <= 3


def test_rule_model():
    for bad in ({"severity": "grave"}, {"dimension": "x"}, {"meaning": "x"}, {"repair": "x"}, {"state": "x"}, {"confirmed_by": "someone"}):
        with pytest.raises(ValueError):
            Rule("r", "is_numeric", {"column": "v"}, **bad)
    with pytest.raises(ValueError):
        Rule("r", "unique_key", {"columns": ["a"], "missing": "fail", "blank_is_missing": True}, repair="strip")
    with pytest.raises(ValueError):
        Rule("r")  # in force without a predicate
    idea = Rule("idea", state="proposed")
    assert unbound([idea, Rule("r", "is_numeric", {"column": "v"}, meaning="amount")]) == ["idea"]
    found = Rule("f", "is_numeric", {"column": "v"}, "proposed", found_by="suggest")
    with pytest.raises(ValueError):
        found.to("confirmed")
    with pytest.raises(ValueError):
        found.to("enforced", by="someone")
    used = found.to("confirmed", by="someone").to("enforced")
    assert used.state == "enforced" and used.to("retired").state == "retired"
    with pytest.raises(ValueError):
        used.to("retired").to("enforced")


def test_warnings_do_not_divide(spark):
    df = spark.createDataFrame([("1",), ("x",)], "v string")
    good, bad = split(df, [Rule("n", "is_numeric", {"column": "v"}, severity="warning")])
    assert good.count() == 2 and bad.count() == 0 and bad.columns == ["v", "broken_rules"]


def test_repairs_of_the_same_column_are_undone(spark):
    df = spark.createDataFrame([(" AB ", 1), ("ab", 2), (None, 3)], "v string, k int")
    some = [Rule("s", "matches", {"column": "v", "pattern": "nmtoken"}, repair="strip"), Rule("f", "in_set", {"column": "v", "values": ["ab"]}, repair="fold_case")]
    fixed = repair(df, some)
    assert [r.v for r in fixed.orderBy("k").collect()] == ["ab", "ab", None]
    assert [[n.before for n in r.repairs] for r in fixed.orderBy("k").collect()] == [[" AB ", "AB"], [], []]
    assert sorted(undo(fixed).collect(), key=lambda r: r.k) == df.orderBy("k").collect()
    with pytest.raises(ValueError):
        repair(fixed, some)


def eleven(base):
    d = list(map(int, base))
    ten = (7 * sum(d[0::2]) - sum(d[1::2])) % 10
    return base + str(ten) + str((sum(d) + ten) % 10)


def test_checksums(spark):
    good = eleven("123456789")
    iban = "GB82WEST12345698765432"  # the standard's own example
    df = spark.createDataFrame([(good, True, False), (good[:-1] + str((int(good[-1]) + 1) % 10), False, False), (iban, False, True), ("79927398713", None, None)], "v string, a boolean, b boolean")
    made = [Rule("r", "has_checksum", {"column": "v", "scheme": s}).holds() for s in ("eleven_digit_id", "iban", "luhn")]
    rows = df.select("a", "b", *(m.alias(f"c{k}") for k, m in enumerate(made))).collect()
    assert all(r.a == r.c0 and r.b == r.c1 for r in rows[:3])
    assert rows[3].c2


def test_keys_with_absent_parts(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1), (None, 1)], "a int, b int")
    rule = lambda m: Rule("k", "unique_key", {"columns": ["a", "b"], "missing": m, "blank_is_missing": False})
    assert [rule(m).faults(df).count() for m in ("pass", "skip", "fail")] == [2, 2, 4]
    assert [tuple(summarise(df, [rule(m)]).select("evaluated", "skipped", "violations").first()) for m in ("pass", "skip", "fail")] == [(5, 0, 2), (3, 2, 2), (5, 0, 4)]
    assert summarise(df.limit(0), [rule("fail")]).first().hold_rate is None


def test_split(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "v string")
    good, bad = split(df, [Rule("n", "is_numeric", {"column": "v"}), Rule("p", "is_present", {"column": "v", "blank_is_missing": True})])
    assert [r.v for r in good.collect()] == ["1"]
    assert {(r.v, tuple(r.broken_rules)) for r in bad.collect()} == {("x", ("n",)), (None, ("n", "p"))}


def test_pushdown_and_no_python(spark):
    from granary import catalogue

    from .conftest import DATA

    df = Rule("s", "in_set", {"column": "l_returnflag", "values": ["A"]}).faults(spark.read.parquet(f"{DATA}/lineitem.parquet")).select("l_orderkey")
    plan = catalogue.QUERIES["rule_summary_flagship"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert "l_comment" not in df._jdf.queryExecution().executedPlan().toString()
