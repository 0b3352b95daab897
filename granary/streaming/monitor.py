"""Quality rules over a stream: violations by window, late rows bounded by a watermark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.rules import Rule, counted


def windowed(stream: DataFrame, rules: Sequence[Rule], at: str, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """start, rule_id, evaluated, skipped, violations. Works on a static table as well. The state is one row a window."""
    live = [r for r in rules if r.by_row]
    sums, rows = counted(live, dict(stream.dtypes))
    by_window = stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late).groupBy(F.window(at, window).alias("w")).agg(*sums)
    return by_window.select(F.col("w.start").alias("start"), rows)
