"""Named queries of the data-quality engine over the test tables, each with its SQL where SQL can state it."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import personal, text
from .operators import profile, rules
from .operators.rules import Rule
from .plans import readiness
from .sources import delimited, publish, schema, store, tables
from .streaming import monitor

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _scratch(spark: SparkSession) -> str:
    """A place in a fresh folder of the cluster's shared one; the folder goes when the JVM ends."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        import tempfile

        if not spark.conf.get("spark.master", "").startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = "file://" + tempfile.mkdtemp(prefix="granary-")
    at = f"{at}/granary-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return f"{at}/x"


LINE_RULES = (
    Rule("flag known", "in_set", {"column": "l_returnflag", "values": ["A", "N"]}),
    Rule("quantity in range", "in_range", {"column": "l_quantity", "least": 2, "most": 48}),
    Rule("discount in range", "in_range", {"column": "l_discount", "least": 0.0, "most": 0.09}),
    Rule("status one letter", "length_between", {"column": "l_linestatus", "least": 1, "most": 1}),
    Rule("key unique", "unique_key", {"columns": ["l_orderkey", "l_linenumber"], "missing": "fail", "blank_is_missing": False}),
)
_RATE = "1 - violations / evaluated::double"
_BAND = f"case when {_RATE} >= 1 then 'always' when {_RATE} >= 0.99 then 'nearly always' when {_RATE} >= 0.9 then 'often' else 'hardly' end"
_SUMMARY = f"select rule_id, evaluated, 0::bigint skipped, violations, {_RATE} hold_rate, {_BAND} band from ({{}})"


@query(
    _SUMMARY.format("""
    select 'flag known' rule_id, count(*) evaluated, count(*) filter (l_returnflag not in ('A', 'N')) violations from lineitem
    union all select 'quantity in range', count(*), count(*) filter (l_quantity not between 2 and 48) from lineitem
    union all select 'discount in range', count(*), count(*) filter (l_discount not between 0 and 0.09::double) from lineitem
    union all select 'status one letter', count(*), count(*) filter (length(l_linestatus) <> 1) from lineitem
    union all select 'key unique', (select count(*) from lineitem), coalesce(sum(n), 0)::bigint from
        (select count(*) n from lineitem group by l_orderkey, l_linenumber having count(*) > 1)""")
)
def rule_summary_flagship(spark, sf_dir):
    return rules.summarise(_t(spark, sf_dir, "lineitem"), LINE_RULES)


def _holds(df: DataFrame, key: str, rule: Rule) -> DataFrame:
    return df.select(key, rule.holds().alias("holds"))


@query("select o_orderkey, coalesce(nullif(o_orderstatus, 'F') is null, false) is_missing, not coalesce(nullif(o_orderstatus, 'F') is null, false) is_present from orders")
def p_null(spark, sf_dir):
    df = _t(spark, sf_dir, "orders").withColumn("s", F.expr("nullif(o_orderstatus, 'F')"))
    both = [Rule(n, n, {"column": "s", "blank_is_missing": True}).holds().alias(n) for n in ("is_missing", "is_present")]
    return df.select("o_orderkey", *both)


@query("""select o_orderkey, regexp_full_match(o_orderpriority, '[A-Za-z0-9._:-]+') nmtoken,
    regexp_full_match(o_orderkey::varchar, '[+-]?[0-9]+') xsd_integer,
    regexp_full_match(d, '[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])') rfc3339_date
    from (select *, strftime(o_orderdate, '%Y-') || lpad((o_orderkey % 14)::varchar, 2, '0') || strftime(o_orderdate, '-%d') d from orders)""")
def p_pattern(spark, sf_dir):
    d = "date_format(o_orderdate, 'yyyy-') || lpad(string(o_orderkey % 14), 2, '0') || date_format(o_orderdate, '-dd')"
    df = _t(spark, sf_dir, "orders").withColumns({"k": F.col("o_orderkey").cast("string"), "d": F.expr(d)})
    by = {"nmtoken": "o_orderpriority", "xsd_integer": "k", "rfc3339_date": "d"}
    return df.select("o_orderkey", *(Rule(p, "matches", {"column": c, "pattern": p}).holds().alias(p) for p, c in by.items()))


_EMAIL = "[a-zA-Z0-9.!#$%&''*+/=?^_`{|}~-]+@[a-zA-Z0-9]([a-zA-Z0-9-]{0,61}[a-zA-Z0-9])?([.][a-zA-Z0-9]([a-zA-Z0-9-]{0,61}[a-zA-Z0-9])?)*"


@query(f"""select w word, count(*) n from (select unnest(string_split_regex(text, '[ \\t\\n\\r\\f\\v]+')) w from documents)
    where regexp_full_match(w, '{_EMAIL}') group by w""")
def p_email_words(spark, sf_dir):
    words = _t(spark, sf_dir, "documents").select(F.explode(F.split("text", r"[ \t\n\r\f\x0B]+")).alias("word"))
    return words.where(Rule("e", "matches", {"column": "word", "pattern": "html_email"}).holds()).groupBy("word").agg(F.count("*").alias("n"))


@query("select c_custkey, length(c_name) between 1 and 17 holds from customer")
def p_length(spark, sf_dir):
    return _holds(_t(spark, sf_dir, "customer"), "c_custkey", Rule("l", "length_between", {"column": "c_name", "least": 1, "most": 17}))


@query("select o_orderkey, o_orderpriority in ('1-URGENT', '2-HIGH') holds from orders")
def p_in_set(spark, sf_dir):
    return _holds(_t(spark, sf_dir, "orders"), "o_orderkey", Rule("s", "in_set", {"column": "o_orderpriority", "values": ["1-URGENT", "2-HIGH"]}))


@query("""select c_custkey, regexp_full_match(v, '[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?') is_numeric,
    coalesce(case when regexp_full_match(v, '[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?') then try_cast(v as double) end between 0 and 500, false) in_range
    from (select c_custkey, case c_custkey % 5 when 0 then c_name when 1 then '1d' when 2 then '1e2' else c_custkey::varchar end v from customer)""")
def p_numeric(spark, sf_dir):
    v = "case c_custkey % 5 when 0 then c_name when 1 then '1d' when 2 then ' 1e2\n' else string(c_custkey) end"
    df = _t(spark, sf_dir, "customer").withColumn("v", F.expr(v))
    ranged = Rule("r", "in_range", {"column": "v", "least": 0, "most": 500})
    return df.select("c_custkey", Rule("n", "is_numeric", {"column": "v"}).holds().alias("is_numeric"), ranged.holds().alias("in_range"))


def _digit(k: int) -> str:
    return f"substr(x, {k}, 1)::int"


_ODD, _EVEN = (" + ".join(_digit(k) for k in ks) for ks in ((1, 3, 5, 7, 9), (2, 4, 6, 8)))
_TAX = " + ".join(
    f"(case when ({_digit(i + 1)} + {9 - i}) % 10 = 0 then 0 when (({_digit(i + 1)} + {9 - i}) % 10 * {2 ** (9 - i)}) % 9 = 0 then 9 else (({_digit(i + 1)} + {9 - i}) % 10 * {2 ** (9 - i)}) % 9 end)"
    for i in range(9)
)


@query(f"""select k, case when x[1] = '0' then false else ((7 * ({_ODD}) - ({_EVEN})) % 10 + 10) % 10 = {_digit(10)} and ({_ODD} + {_EVEN} + {_digit(10)}) % 10 = {_digit(11)} end eleven_digit_id,
    (10 - ({_TAX}) % 10) % 10 = {_digit(10)} ten_digit_tax_id,
    list_sum([case when i % 2 = 1 then (case when {{d}} * 2 > 9 then {{d}} * 2 - 9 else {{d}} * 2 end) else {{d}} end for i in range(11)]) % 10 = 0 luhn
    from (select o_orderkey k, lpad((o_orderkey * 7919 + 10000000146)::varchar, 11, '0') x from orders)""".replace("{d}", "substr(x, (11 - i)::int, 1)::int"))
def p_checksum(spark, sf_dir):
    df = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.expr("lpad(string(o_orderkey * 7919 + 10000000146), 11, '0')").alias("x"))
    df = df.withColumn("x10", F.substring("x", 1, 10))
    by = {"eleven_digit_id": "x", "ten_digit_tax_id": "x10", "luhn": "x"}
    return df.select("k", *(Rule(s, "has_checksum", {"column": c, "scheme": s}).holds().alias(s) for s, c in by.items()))


@query("""select o_orderkey, try_cast(d as date) is not null holds from
    (select o_orderkey, strftime(o_orderdate, '%Y-%m-') || lpad((o_orderkey % 40)::varchar, 2, '0') d from orders)""")
def p_iso_date(spark, sf_dir):
    d = "date_format(o_orderdate, 'yyyy-MM-') || lpad(string(o_orderkey % 40), 2, '0')"
    return _holds(_t(spark, sf_dir, "orders").withColumn("d", F.expr(d)), "o_orderkey", Rule("d", "is_iso_date", {"column": "d"}))


@query("""select l_orderkey, l_linenumber, l_partkey, l_suppkey, o_orderdate <= l_shipdate not_after, o_custkey = l_suppkey equal
    from lineitem join orders on l_orderkey = o_orderkey""")
def p_between_columns(spark, sf_dir):
    df = _t(spark, sf_dir, "lineitem").join(_t(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    policy = {"missing": "fail", "blank_is_missing": False}
    before = Rule("b", "not_after", {"left": "o_orderdate", "right": "l_shipdate"} | policy)
    same = Rule("e", "equal", {"left": "o_custkey", "right": "l_suppkey"} | policy)
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", before.holds().alias("not_after"), same.holds().alias("equal"))


@query(
    _SUMMARY.format("""
    select 'order unique' rule_id, count(*) evaluated, (select coalesce(sum(n), 0)::bigint from (select count(*) n from orders group by o_orderkey having count(*) > 1)) violations from orders
    union all select 'customer unique', count(*), (select coalesce(sum(n), 0)::bigint from (select count(*) n from orders group by o_custkey having count(*) > 1)) from orders
    union all select 'few priorities', count(*), case when count(distinct o_orderpriority) > 5 then count(*) else 0 end from orders
    union all select 'few customers', count(*), case when count(distinct o_custkey) > 3 then count(*) else 0 end from orders""")
)
def set_rules(spark, sf_dir):
    some = [
        Rule("order unique", "unique_key", {"columns": ["o_orderkey"], "missing": "fail", "blank_is_missing": False}),
        Rule("customer unique", "unique_key", {"columns": ["o_custkey"], "missing": "pass", "blank_is_missing": False}),
        Rule("few priorities", "distinct_at_most", {"column": "o_orderpriority", "most": 5, "blank_is_missing": False}),
        Rule("few customers", "distinct_at_most", {"column": "o_custkey", "most": 3, "blank_is_missing": False}),
    ]
    return rules.summarise(_t(spark, sf_dir, "orders"), some)


@query("select l_orderkey, l_linenumber, count(*) n from lineitem group by all having count(*) > 1")
def duplicate_keys(spark, sf_dir):
    rule = Rule("k", "unique_key", {"columns": ["l_orderkey", "l_linenumber"], "missing": "fail", "blank_is_missing": False})
    return rule.faults(_t(spark, sf_dir, "lineitem")).groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n"))


@query("""select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
    array_to_string(list_filter([case when l_returnflag not in ('A', 'N') then 'flag known' end, case when l_quantity not between 2 and 48 then 'quantity in range' end,
    case when l_discount not between 0 and 0.09::double then 'discount in range' end], lambda x: x is not null), ',') broken
    from lineitem where l_returnflag not in ('A', 'N') or l_quantity not between 2 and 48 or l_discount not between 0 and 0.09::double""")
def quarantine(spark, sf_dir):
    bad = rules.split(_t(spark, sf_dir, "lineitem"), LINE_RULES[:3])[1]
    return bad.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", F.array_join("broken_rules", ",").alias("broken"))


@query(
    " union all ".join(
        f"select '{c}' column_name, count(*) \"rows\", count(*) - count({c}) nulls, count(distinct {c}) distinct_values, (count(*) - count({c})) / count(*)::double null_rate from orders"
        for c in ("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    )
)
def profile_columns(spark, sf_dir):
    return profile.columns(_t(spark, sf_dir, "orders"), ("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus"))


@query("""select regexp_replace(regexp_replace(p_name, '[0-9]', '9', 'g'), '[A-Za-z]', 'A', 'g') shape, count(*) "rows" from part
    group by 1 order by 2 desc, 1 limit 10""")
def top_shapes(spark, sf_dir):
    return profile.top_shapes(_t(spark, sf_dir, "part"), "p_name", 10)


@query("select o_orderpriority value, count(*) \"rows\" from orders group by 1")
def k_anonymous_values(spark, sf_dir):
    return profile.safe_values(_t(spark, sf_dir, "orders"), "o_orderpriority")


@query("select count(*) \"rows\", count(ts) parsed, strftime(max(ts), '%Y-%m-%d %H:%M:%S') latest, (epoch_us(timestamp '2026-01-01') - epoch_us(max(ts)))::double / 3600000000.0::double age_hours from events")
def freshness(spark, sf_dir):
    events = _t(spark, sf_dir, "events").select(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("at"))
    seen = delimited.probe(events, "at")
    age = delimited.age_hours(F.col("latest"), F.lit("2026-01-01 00:00:00").cast("timestamp"))
    return seen.select("rows", "parsed", F.date_format("latest", "yyyy-MM-dd HH:mm:ss").alias("latest"), age.alias("age_hours"))


@query("""select doc_id, case when length(d) >= 10 then right(d, 10) else d end tail from
    (select doc_id, regexp_replace(text, '[^0-9]', '', 'g') d from documents)""")
def phone_tails(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", text.phone_tail(F.col("text")).alias("tail"))


@query("""select c_mktsegment, count(*) dependents, sum(n)::bigint "rows" from
    (select c_mktsegment, c_nationkey, count(*) n from customer group by all) group by 1 having count(*) > 1""")
def dependency_faults(spark, sf_dir):
    return profile.dependency_faults(_t(spark, sf_dir, "customer"), ["c_mktsegment"], "c_nationkey")


@query("select l_suppkey value, count(*) \"rows\" from lineitem where l_suppkey not in (select n_nationkey from nation) group by 1")
def inclusion_faults(spark, sf_dir):
    return profile.inclusion_faults(_t(spark, sf_dir, "lineitem"), "l_suppkey", _t(spark, sf_dir, "nation"), "n_nationkey")


@query(
    " union all ".join(
        f"select '{','.join(c)}' combination, sum(n)::bigint \"rows\", count(*) distinct_rows, sum(n) = count(*) is_key from (select count(*) n from lineitem group by {', '.join(c)})"
        for c in (("l_orderkey",), ("l_orderkey", "l_linenumber"), ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    )
)
def unique_combinations(spark, sf_dir):
    some = (("l_orderkey",), ("l_orderkey", "l_linenumber"), ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    return profile.unique_combinations(_t(spark, sf_dir, "lineitem"), some)


@query("""with d as (select cast(ts as date) "day", count(*) n from events group by 1)
    select strftime("day", '%Y-%m-%d') "day", n, round(avg(n) over w, 6) mean, round(stddev_samp(n) over w, 6) deviation from d window w as (order by "day" rows between 7 preceding and 1 preceding)""")
def temporal_baseline(spark, sf_dir):
    days = _t(spark, sf_dir, "events").groupBy(F.col("ts").cast("date").alias("day")).agg(F.count("*").alias("n"))
    out = profile.baseline(days, "day", "n")
    return out.select(F.col("day").cast("string").alias("day"), "n", *(F.round(c, 6).alias(c) for c in ("mean", "deviation")))


EVENT_RULES = (
    Rule("value in range", "in_range", {"column": "value", "least": 0, "most": 100}),
    Rule("type known", "in_set", {"column": "event_type", "values": ["click", "view", "purchase"]}),
)


@query("""with w as (select time_bucket(interval '1 hour', ts) h, count(*) n, count(*) filter (not coalesce(value between 0 and 100, false)) a,
    count(*) filter (not coalesce(event_type in ('click', 'view', 'purchase'), false)) b from events group by 1)
    select strftime(h, '%Y-%m-%d %H:%M') "start", 'value in range' rule_id, n evaluated, 0::bigint skipped, a violations from w
    union all select strftime(h, '%Y-%m-%d %H:%M'), 'type known', n, 0, b from w""")
def windowed_rules(spark, sf_dir):
    out = monitor.windowed(_t(spark, sf_dir, "events"), EVENT_RULES, "ts")
    return out.withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm"))


@query("""with f as (select count(*) n, (epoch_us(timestamp '2026-01-01') - epoch_us(max(o_orderdate))) / 3.6e9 age from orders),
    k as (select coalesce(sum(n), 0)::bigint bad from (select o_orderkey, count(*) n from orders group by 1 having count(*) > 1 or o_orderkey is null))
    select 'columns present' "check", 'passed' status, '' observed
    union all select 'rows within bounds', case when n between 1 and 1000000000 then 'passed' else 'failed' end, n::varchar from f
    union all select 'fresh', case when age <= 100000 then 'passed' else 'failed' end, round(age, 3)::varchar from f
    union all select 'key complete and unique', case when bad = 0 then 'passed' else 'failed' end, bad::varchar from k""")
def readiness_report(spark, sf_dir):
    contract = readiness.Contract(
        ("o_orderkey", "o_custkey", "o_orderdate"), ("o_orderkey",), most_rows=10**9, instant="o_orderdate", fresh_hours=100_000
    )
    return readiness.judge(_t(spark, sf_dir, "orders"), contract, datetime(2026, 1, 1, tzinfo=UTC))


@query("select n_nationkey::varchar n_nationkey, n_name, n_regionkey::varchar n_regionkey from nation")
def delimited_round_trip(spark, sf_dir):
    at = _scratch(spark)
    _t(spark, sf_dir, "nation").write.option("header", True).option("sep", ";").csv(at)
    return delimited.read(spark, at)


@query("select * from supplier")
def store_round_trip(spark, sf_dir):
    run = store.Run("r1")
    record = store.write(_t(spark, sf_dir, "supplier"), _scratch(spark), "catalogue")
    return run.add(record).read(spark, record.id)


@query("""select c_custkey, replace(replace(t, '.', ''), ',', '.')::decimal(38,10)::double amount, 'a b' label from
    (select c_custkey, replace(format('{:.2f}', c_acctbal), '.', ',') t from customer)""")
def transforms(spark, sf_dir):
    df = _t(spark, sf_dir, "customer").select("c_custkey", F.replace(F.format_string("%.2f", F.col("c_acctbal")), F.lit("."), F.lit(",")).alias("t"))
    return df.select("c_custkey", text.decimal_of(F.col("t")).cast("double").alias("amount"), text.collapse(F.lit("  a \n b ")).alias("label"))




ORDERS = schema.Schema.from_dict(
    {
        "id": "orders/1",
        "key": ["order_id"],
        "instant": "ordered_at",
        "fields": [
            {"name": "order_id", "meaning": "identifier", "required": True},
            {"name": "customer", "meaning": "person id", "required": True},
            {"name": "total", "meaning": "amount"},
            {"name": "ordered_at", "meaning": "instant"},
        ],
    }
)


@query("""select o_orderkey order_id, o_custkey customer, o_totalprice total, strftime(o_orderdate, '%Y-%m-%d') ordered_at, 'customer' personal from orders""")
def schema_binding(spark, sf_dir):
    df = _t(spark, sf_dir, "orders")
    names = {"o_orderkey": "order_id", "o_custkey": "customer", "o_totalprice": "total", "o_orderdate": "ordered_at"}
    bound = schema.apply(df, schema.bind(df, ORDERS, names))
    personal = ",".join(schema.personal_columns(bound))
    return bound.withColumns({"ordered_at": F.date_format("ordered_at", "yyyy-MM-dd"), "personal": F.lit(personal)})


@query("select s_suppkey, s_name, s_nationkey, s_acctbal from supplier union all select s_suppkey, s_name, s_nationkey, s_acctbal from supplier")
def sources_union(spark, sf_dir):
    df, at = _t(spark, sf_dir, "supplier"), _scratch(spark)
    tables.write(df, tables.Source("orc", (f"{at}-orc",)))
    tables.write(df, tables.Source("json", (f"{at}-json",)))
    orc = tables.read(spark, tables.Source("orc", (f"{at}-orc",)))
    back = tables.read(spark, tables.Source("json", (f"{at}-json",))).select(*(F.col(f.name).cast(f.dataType) for f in df.schema))
    return orc.unionByName(back)


#: Half of the customers' names have white space and case of their own; a few amounts are blank.
_MESSY = """select c_custkey, case c_custkey % 4 when 0 then concat('  ', upper(c_name), ' ') when 1 then '' else c_name end name,
    case c_custkey % 7 when 0 then null when 1 then '  ' else cast(c_nationkey as string) end a, cast(c_custkey % 25 as string) b from {}"""


def _messy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_MESSY.format("{customers}"), customers=_t(spark, sf_dir, "customer"))


_POLICIES = [(m, b) for m in ("pass", "fail", "skip") for b in (True, False)]


@query(
    "with m as ("
    + _MESSY.format("customer").replace("as string", "as varchar")
    + "), p as (select *, a is null gone, a is null or trim(a) = '' blank_gone from m) "
    + " union all ".join(
        f"""select '{m} {b}' rule_id, count(*) {"filter (not " + g + ")" if m == "skip" else ""} evaluated,
        {"count(*) filter (" + g + ")" if m == "skip" else "0::bigint"} skipped, count(*) filter (not (case when {g} then {str(m != "fail").lower()} else a = b end)) violations from p"""
        for m, b in _POLICIES
        for g in ("blank_gone" if b else "gone",)
    )
)
def missing_policies(spark, sf_dir):
    """Every policy for missing and blank sides of a pair; skipped rows are counted on their own."""
    some = [Rule(f"{m} {b}", "equal", {"left": "a", "right": "b", "missing": m, "blank_is_missing": b}) for m, b in _POLICIES]
    return rules.summarise(_messy(spark, sf_dir), some).drop("hold_rate", "band")


@query(
    "with m as ("
    + _MESSY.format("customer").replace("as string", "as varchar")
    + "), n as (select *, a is null or trim(a) = '' gone, count(*) over (partition by a, b) n from m) "
    + " union all ".join(
        f"""select '{m}' rule_id, count(*) {"filter (not gone)" if m == "skip" else ""} evaluated, {"count(*) filter (gone)" if m == "skip" else "0::bigint"} skipped,
        count(*) filter ({"gone or n > 1" if m == "fail" else "not gone and n > 1"}) violations from n"""
        for m in ("pass", "fail", "skip")
    )
)
def key_policies(spark, sf_dir):
    some = [Rule(m, "unique_key", {"columns": ["a", "b"], "missing": m, "blank_is_missing": True}) for m in ("pass", "fail", "skip")]
    return rules.summarise(_messy(spark, sf_dir), some).drop("hold_rate", "band")


NAME_RULES = (
    Rule("name trimmed", "matches", {"column": "name", "pattern": "nmtoken"}, repair="strip", dimension="validity"),
    Rule("name folded", "in_set", {"column": "name", "values": []}, repair="fold_case", severity="warning"),
)


@query(
    "with m as ("
    + _MESSY.format("customer").replace("as string", "as varchar")
    + """) select c_custkey, lower(trim(name)) name, name undone, len(list_distinct(list_filter([
    case when not regexp_full_match(name, '[A-Za-z0-9._:-]+') and trim(name) <> name then 1 end, case when lower(trim(name)) <> trim(name) then 2 end], lambda x: x is not null)))::int repairs from m"""
)
def repairs(spark, sf_dir):
    """Repairs by rules, and the table as it was before them."""
    fixed = rules.repair(_messy(spark, sf_dir).select("c_custkey", "name"), NAME_RULES)
    back = rules.undo(fixed).withColumnRenamed("name", "undone")
    return fixed.select("c_custkey", F.trim("name").alias("name"), F.size("repairs").alias("repairs")).join(back, "c_custkey")


@query("""with b as (select *, l_quantity not between 2 and 48 or l_discount not between 0 and 0.09::double or l_returnflag not in ('A', 'N') bad from lineitem)
    select 'published' part, count(*) filter (not bad) n, sum(l_partkey) filter (not bad)::bigint total from b
    union all select 'quarantined', count(*) filter (bad), sum(l_partkey) filter (bad)::bigint from b""")
def write_audit_publish(spark, sf_dir):
    """lineitem staged, audited and published; the rows at fault in their quarantine."""
    at = _scratch(spark)
    df = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_discount", "l_returnflag")
    publish.publish(df, LINE_RULES[:3], f"{at}/good", f"{at}/bad", least_rate=0.5)
    parts = [spark.read.parquet(f"{at}/{n}").agg(F.lit(p).alias("part"), F.count("*").alias("n"), F.sum("l_partkey").alias("total")) for n, p in (("good", "published"), ("bad", "quarantined"))]
    return parts[0].unionByName(parts[1])


@query("""select n_nationkey::varchar n_nationkey, n_name || ' İŞĞ' n_name from nation""")
def encodings(spark, sf_dir):
    """A table in Windows-1254, a character set that Spark's reader refuses, written line by line and read back."""
    at = _scratch(spark)
    lines = _t(spark, sf_dir, "nation").select(F.format_string("%d;%s İŞĞ", "n_nationkey", "n_name").alias("l"))
    text_ = "n_nationkey;n_name\n" + "\n".join(r.l for r in lines.collect()) + "\n"  # a dimension of 25 rows
    out = spark._jvm.org.apache.hadoop.fs.Path(f"{at}/nation.csv")
    stream = out.getFileSystem(spark._jsc.hadoopConfiguration()).create(out, False)
    stream.write(text_.encode("cp1254"))
    stream.close()
    return delimited.read(spark, at, encoding="cp1254")


@query("""select l_orderkey, l_linenumber, l_quantity, max(exceeded_by) exceeded_by from (
    select *, max(l_quantity) over (partition by l_orderkey order by l_linenumber range between unbounded preceding and 1 preceding) exceeded_by from lineitem)
    where exceeded_by > l_quantity group by all""")
def denial_constraints(spark, sf_dir):
    df = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    faults = profile.order_faults(df, ["l_orderkey"], "l_linenumber", "l_quantity")
    return faults.groupBy("l_orderkey", "l_linenumber", "l_quantity").agg(F.max("exceeded_by").alias("exceeded_by"))


@query("""select 'o_custkey in_range' id, min(o_custkey)::double::varchar || ' ' || max(o_custkey)::double::varchar params from orders
    union all select 'o_custkey is_present', '' from orders having count(*) = count(o_custkey)
    union all select 'o_orderpriority in_set', string_agg(distinct o_orderpriority, '|' order by o_orderpriority) from orders
    union all select 'o_orderpriority is_present', '' from orders having count(*) = count(o_orderpriority)""")
def suggested_rules(spark, sf_dir):
    found = profile.suggest(_t(spark, sf_dir, "orders"), ["o_custkey", "o_orderpriority"])
    plain = {"in_range": lambda p: f"{p['least']} {p['most']}", "in_set": lambda p: "|".join(p["values"]), "is_present": lambda p: ""}
    return spark.createDataFrame([(r.id, plain[r.predicate](r.params)) for r in found], "id string, params string")


@query("""select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') "day", lower(replace(o_orderpriority, 'I', 'i')) || ' ss' folded from orders""")
def folds_and_dates(spark, sf_dir):
    """Dates in three notations, and texts folded for comparison."""
    df = _t(spark, sf_dir, "orders").withColumn("d", F.expr("case o_orderkey % 3 when 0 then date_format(o_orderdate, 'yyyy-MM-dd') when 1 then date_format(o_orderdate, 'dd.MM.yyyy') else date_format(o_orderdate, ' dd/MM/yyyy ') end"))
    folded = text.fold_case(F.concat("o_orderpriority", F.lit(" ß")))
    return df.select("o_orderkey", text.date_of(F.col("d")).cast("string").alias("day"), folded.alias("folded"))


_CARDS = "list_filter(regexp_extract_all(regexp_replace(' ' || text || ' ', '[^0-9A-Za-z]', '  ', 'g'), '[^0-9A-Za-z]([0-9]{13,19})[^0-9A-Za-z]', 1), lambda x: list_sum(list_transform(range(length(x)), lambda i: case when i % 2 = 1 then (case when substr(x, (length(x) - i)::int, 1)::int > 4 then substr(x, (length(x) - i)::int, 1)::int * 2 - 9 else substr(x, (length(x) - i)::int, 1)::int * 2 end) else substr(x, (length(x) - i)::int, 1)::int end)) % 10 = 0)"


@query(f"""select doc_id, len({_CARDS})::int card, regexp_matches(text, '(^|[^a-zA-Z0-9])[a-zA-Z0-9.!#$%&''*+/=?^_`{{|}}~-]+@[a-zA-Z0-9]') has_email from documents""")
def personal_data(spark, sf_dir):
    """Card numbers with right check digits in each document, and whether it holds an e-mail address."""
    df = _t(spark, sf_dir, "documents")
    n = personal.counts(F.col("text"))
    return df.select("doc_id", n["card"], (n["email"] > 0).alias("has_email"))
