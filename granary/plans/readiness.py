"""Is a table ready to be used? A declared contract, judged from one scan and one grouping by key."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import iso_instant


@dataclass(frozen=True)
class Contract:
    columns: tuple[str, ...]
    key: tuple[str, ...]
    least_rows: int = 1
    most_rows: int | None = None
    instant: str | None = None
    fresh_hours: float | None = None

    def __post_init__(self):
        if not self.key or set(self.key) - set(self.columns):
            raise ValueError("the key is one or more of the columns")
        if self.most_rows is not None and self.most_rows < self.least_rows:
            raise ValueError("most_rows is below least_rows")


def judge(df: DataFrame, contract: Contract, now: datetime) -> DataFrame:
    """check, status (passed, failed or not judged), observed. now is given, so that a report can be made again."""
    spark = df.sparkSession
    lacking = sorted(set(contract.columns) - set(df.columns))
    first = spark.createDataFrame(
        [("columns present", "failed" if lacking else "passed", ", ".join(lacking))], "check string, status string, observed string"
    )
    says = lambda name, good, seen: F.struct(
        F.lit(name).alias("check"),
        F.when(good.isNull(), "not judged").when(good, "passed").otherwise("failed").alias("status"),
        seen.cast("string").alias("observed"),
    )
    at = F.lit(None).cast("timestamp")
    if contract.instant and contract.instant in df.columns:
        at = F.col(contract.instant)
        at = iso_instant(at) if dict(df.dtypes)[contract.instant] == "string" else at.cast("timestamp")
    facts = df.agg(F.count("*").alias("rows"), F.max(at).alias("latest"))
    most = F.lit(contract.most_rows if contract.most_rows is not None else 2**63 - 1)
    age = (F.lit(now.timestamp()) - F.unix_micros("latest") / 1e6) / 3600
    checks = [
        says("rows within bounds", F.col("rows").between(F.lit(contract.least_rows), most), F.col("rows")),
        says("fresh", age <= F.lit(contract.fresh_hours), F.round(age, 3)),
    ]
    out = first.unionByName(facts.select(F.inline(F.array(*checks))))
    if lacking:
        return out
    keys = df.groupBy(*contract.key).agg(F.count("*").alias("n"))
    null_part = F.lit(False)
    for c in contract.key:
        null_part = null_part | F.col(c).isNull()
    faults = keys.agg(F.coalesce(F.sum(F.when((F.col("n") > 1) | null_part, F.col("n"))), F.lit(0)).alias("bad"))
    return out.unionByName(faults.select(F.inline(F.array(says("key complete and unique", F.col("bad") == 0, F.col("bad"))))))
