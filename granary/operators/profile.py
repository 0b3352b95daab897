"""Profiles and dependency discovery on plain aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import shape
from .predicates import is_number
from .rules import Rule


def columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """column_name, rows, nulls, distinct_values, null_rate. One scan and one grouping by column and value (as text; combined before the
    shuffle), whatever the number of columns."""
    types = dict(df.dtypes)
    plain = lambda c: F.to_json(F.struct(F.col(c).alias("v"))) if types[c].startswith(("array", "map", "struct")) else F.col(c).cast("string")
    each = F.array(*(F.struct(F.lit(c).alias("column_name"), F.when(F.col(c).isNotNull(), plain(c)).alias("v")) for c in names))
    by_value = df.select(F.inline(each)).groupBy("column_name", "v").agg(F.count("*").alias("n"))
    seen = by_value.groupBy("column_name").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.count("v").alias("distinct_values"),
    )
    all_ = df.sparkSession.createDataFrame([(c,) for c in names], "column_name string")  # a table without rows has columns too
    out = all_.join(F.broadcast(seen), "column_name", "left").fillna(0)
    return out.withColumn("null_rate", F.when(F.col("rows") > 0, F.col("nulls") / F.col("rows")))


def top_shapes(df: DataFrame, name: str, k: int) -> DataFrame:
    """The k most frequent masks of a text column; ties go to the lesser mask."""
    counts = df.where(F.col(name).isNotNull()).groupBy(shape(F.col(name)).alias("shape")).agg(F.count("*").alias("rows"))
    return counts.orderBy(F.desc("rows"), "shape").limit(k)


def safe_values(df: DataFrame, name: str, k: int = 5, most: int = 50) -> DataFrame:
    """The values of a column with their rows, if it has at most so many and each stands for k rows or more; else nothing.
    At most (most + 1) rows are looked at after the grouping."""
    counts = df.where(F.col(name).isNotNull()).groupBy(F.col(name).cast("string").alias("value")).agg(F.count("*").alias("rows"))
    few = counts.limit(most + 1)
    gate = few.agg(((F.count("*") <= most) & (F.min("rows") >= k)).alias("open"))
    return few.crossJoin(F.broadcast(gate)).where("open").drop("open")


def dependency_faults(df: DataFrame, determinant: Sequence[str], dependent: str) -> DataFrame:
    """Determinant values with more than one dependent value: a functional dependency that does not hold there."""
    pairs = df.groupBy(*determinant, dependent).agg(F.count("*").alias("rows"))
    return pairs.groupBy(*determinant).agg(F.count("*").alias("dependents"), F.sum("rows").alias("rows")).where("dependents > 1")


def unique_combinations(df: DataFrame, candidates: Sequence[Sequence[str]]) -> DataFrame:
    """combination, rows, distinct_rows, is_key for each candidate set of columns: one scan and one grouping by all the sets."""
    names = sorted({c for names in candidates for c in names})
    which = {",".join(c): sum(1 << (len(names) - 1 - k) for k, n in enumerate(names) if n not in c) for c in candidates}
    sets = [[F.col(n) for n in c] for c in candidates]
    groups = df.groupingSets(sets, *names).agg(F.grouping_id().alias("g"), F.count("*").alias("n"))
    one = groups.groupBy("g").agg(F.sum("n").alias("rows"), F.count("*").alias("distinct_rows"))
    all_ = df.sparkSession.createDataFrame(list(which.items()), "combination string, g long")
    out = all_.join(F.broadcast(one), "g", "left").fillna(0)
    return out.select("combination", "rows", "distinct_rows", (F.col("rows") == F.col("distinct_rows")).alias("is_key"))


def inclusion_faults(df: DataFrame, name: str, of: DataFrame, other: str) -> DataFrame:
    """Values of df's column that the other table's column lacks, with their rows."""
    have = df.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("value")).agg(F.count("*").alias("rows"))
    return have.join(of.select(F.col(other).alias("value")).distinct(), "value", "left_anti")


def baseline(df: DataFrame, period: str, measure: str, back: int = 7, series: Sequence[str] = ()) -> DataFrame:
    """Each period's measure (its sum, where a period has several rows) against the mean and deviation of up to so many periods before it, series by
    series. What the window sorts is one row a series and period."""
    whole = df.groupBy(*series, period).agg(F.sum(measure).alias(measure))
    before = Window.partitionBy(*series).orderBy(period).rowsBetween(-back, -1)
    return whole.select(*series, period, measure, F.avg(measure).over(before).alias("mean"), F.stddev_samp(measure).over(before).alias("deviation"))


def order_faults(df: DataFrame, within: Sequence[str], by: str, grows: str) -> DataFrame:
    """A denial constraint: within a group no row that is higher in one column may be lower in another. The rows that some row with less of
    by exceeds in grows, with that highest value as exceeded_by. Pairs are never made: rows are sorted and the highest value so far is kept."""
    lower = Window.partitionBy(*within).orderBy(by).rangeBetween(Window.unboundedPreceding, -1)
    kinds = dict(df.dtypes)
    if kinds[by] not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError(f"{by} is no whole number")
    return df.withColumn("exceeded_by", F.max(grows).over(lower)).where(F.col("exceeded_by") > F.col(grows))


def suggest(df: DataFrame, names: Sequence[str], few: int = 10, least_rate: float = 1.0) -> list[Rule]:
    """Rules that a table's columns hold, as proposals: present, one of a few values (texts), within a range (numbers). One scan for the facts
    and one for the values of columns that have few; the driver gets few values a column."""
    types = dict(df.dtypes)
    numeric = [c for c in names if is_number(types, c)]
    facts = df.agg(
        F.count("*").alias("n"),
        *(F.count(c).alias(f"present {c}") for c in names),
        *(f(F.when(~F.isnan(c) if types[c] in ("float", "double") else F.lit(True), F.col(c))).cast("double").alias(f"{w} {c}") for c in numeric for f, w in ((F.min, "least"), (F.max, "most"))),
    ).first()
    out = []
    if not facts["n"]:
        return out
    add = lambda c, name, params, dimension: out.append(
        Rule(f"{c} {name}", name, {"column": c} | params, "proposed", found_by="suggest", dimension=dimension)
    )
    for c in names:
        if facts[f"present {c}"] / facts["n"] >= least_rate:
            add(c, "is_present", {"blank_is_missing": False}, "completeness")
        if c in numeric and facts[f"least {c}"] is not None:
            add(c, "in_range", {"least": facts[f"least {c}"], "most": facts[f"most {c}"]}, "validity")
    texts = [c for c in names if types[c] == "string"]
    if texts:
        counts = columns(df, texts).where(F.col("distinct_values") <= few).select("column_name").collect()
        for (c,) in counts:
            values = sorted(r[0] for r in df.select(c).where(F.col(c).isNotNull()).distinct().limit(few).collect())
            if values:
                add(c, "in_set", {"values": values + ([None] if facts[f"present {c}"] < facts["n"] else [])}, "validity")
    return sorted(out, key=lambda r: r.id)
