"""Write, audit, publish: a table is written to a staging folder, judged there by its rules, and only then put in its place.

The rows at fault go to a quarantine of their own with the rules they break. Publishing is one rename in the target's file system, which
either has happened or has not; a store whose renames are copies (object stores without one) needs a table format instead.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators.rules import Rule, split, summarise


class Withheld(Exception):
    """The audit failed; nothing was published."""


@dataclass(frozen=True)
class Outcome:
    """Rows published and quarantined, and each rule's hold rate on the staged rows."""

    published: int
    quarantined: int
    hold_rates: dict[str, float | None]


def _fs(spark: SparkSession, at: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def publish(df: DataFrame, rules: Sequence[Rule], target: str, quarantine: str, least_rate: float = 0.0) -> Outcome:
    """df is computed once, into a folder beside the target. If every enforced rule of severity error holds for at least least_rate of the
    rows that it is judged on, the rows that break none are published as target and the others written to quarantine; else Withheld is
    raised and the staged rows are deleted. Set rules count in the audit; their rows are not divided. target and quarantine must not be there yet."""
    spark = df.sparkSession
    for at in (target, quarantine):
        path, fs = _fs(spark, at)
        if fs.exists(path):
            raise FileExistsError(at)
    staged = f"{target.rstrip('/')}.staged-{uuid.uuid4().hex}"
    path, fs = _fs(spark, staged)
    try:
        df.write.parquet(f"{staged}/all")
        rows = spark.read.schema(df.schema).parquet(f"{staged}/all")
        gate = [r for r in rules if r.state == "enforced" and r.severity == "error"]
        rates = {r["rule_id"]: r["hold_rate"] for r in summarise(rows, gate).collect()} if gate else {}  # one row a rule
        if low := sorted(k for k, v in rates.items() if v is not None and v < least_rate):
            raise Withheld(f"{target}: {low} hold for less than {least_rate} of the rows")
        good, bad = split(rows, gate)
        good.write.parquet(f"{staged}/good")
        bad.write.parquet(f"{staged}/bad")
        counts = [spark.read.schema(x.schema).parquet(f"{staged}/{n}").count() for x, n in ((good, "good"), (bad, "bad"))]
        for name, at in (("bad", quarantine), ("good", target)):  # the target last: once it is there, all is
            source, to = _fs(spark, f"{staged}/{name}")[0], _fs(spark, at)[0]
            if to.getParent() is not None:
                fs.mkdirs(to.getParent())
            if not fs.rename(source, to):
                raise FileExistsError(at)
    finally:
        fs.delete(path, True)
    return Outcome(*counts, rates)
