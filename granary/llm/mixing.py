"""Mixing sources to target weights by Pfair scheduling.

Each source's rows form blocks. With weights in integer units that add up to W, block j of a source of w units is
released at slot floor(j W / w) and due at ceil((j + 1) W / w); each slot takes the released block with the earliest
deadline. Then after any number of slots each source is less than one block off its share. The schedule repeats every
W slots, so one period (a table whose size is a parameter, not data) gives every block's slot in closed form. When a
source has no block left, a new phase starts with the others' weights. No row is dropped or repeated.

Defined cases: sources without a weight, and null sources, share OTHER; the last block of a source may be short; equal
rows are rows of their own; an empty table gives no rows; the input's other columns are carried or left out as the
caller selects, and names that begin with mix_ are this operator's (ValueError). DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut

#: Units of weight; with OTHER they add up to 100.
WEIGHTS = {"src0": 12, **{f"src{k}": 6 for k in range(1, 5)}, **{f"src{k}": 4 for k in range(5, 20)}}
OTHER, OTHER_WEIGHT, BLOCK = "(other)", 4, 32


@dataclass(frozen=True)
class Phase:
    """From slot start on: block first + q * units + i of a source has slot start + q * W + at[source][i]."""

    start: int
    period: int
    first: dict[str, int]
    until: dict[str, int]
    at: dict[str, list[int]]


def period(units: dict[str, int]) -> list[str]:
    """Who runs in each of the W slots: earliest deadline first among released blocks, ties by name."""
    total, done, out = sum(units.values()), dict.fromkeys(units, 0), []
    for t in range(total):
        ready = [s for s in units if done[s] < units[s] and done[s] * total // units[s] <= t]
        s = min(ready, key=lambda s: (ceil((done[s] + 1) * total / units[s]), s))
        done[s] += 1
        out.append(s)
    return out


def phases(blocks: dict[str, int], units: dict[str, int]) -> list[Phase]:
    """blocks: how many each source has. At most one phase a source."""
    out, slot, used = [], 0, dict.fromkeys(blocks, 0)
    while left := {s: n - used[s] for s, n in blocks.items() if n > used[s]}:
        live = {s: units[s] for s in sorted(left)}
        order = period(live)
        whole = min((left[s] - 1) // live[s] for s in live)
        got = {s: whole * live[s] for s in live}
        tail = 0
        while all(got[s] < left[s] for s in live):
            got[order[tail]] += 1
            tail += 1
        at = {s: [k for k, x in enumerate(order) if x == s] for s in live}
        out.append(Phase(slot, len(order), {s: used[s] for s in live}, {s: used[s] + got[s] for s in live}, at))
        slot += whole * len(order) + tail
        for s in live:
            used[s] += got[s]
    return out


def mix(docs: DataFrame, weights: dict[str, int] | None = None, block: int = BLOCK, other: int = OTHER_WEIGHT) -> DataFrame:
    """docs: source and any other columns. Adds mix_source, mix_block (of the source), mix_slot, mix_position (0, 1, ...
    over all rows). Rows keep their input order inside a source."""
    weights = {OTHER: other} | dict(WEIGHTS if weights is None else weights)
    if min(weights.values()) < 1:
        raise ValueError("a weight is at least one unit")
    if clash := [c for c in docs.columns if c.lower().startswith("mix_")]:
        raise ValueError(f"docs has columns of this operator's: {clash}")
    spark = docs.sparkSession
    named = F.when(F.col("source").isin(*weights), F.col("source")).otherwise(OTHER)
    rows = cut(
        docs.withColumns({"mix_source": F.coalesce(named, F.lit(OTHER)), "mix_uid": F.monotonically_increasing_id()}), "mix"
    ).withColumn("mix_part", F.shiftright("mix_uid", 33))
    counts = cut(rows.groupBy("mix_source", "mix_part").agg(F.count("*").alias("n")), "counts")
    have = {r[0]: r[1] for r in counts.groupBy("mix_source").agg(F.sum("n")).collect()}  # at most one row a weight
    plan = phases({s: -(-n // block) for s, n in have.items()}, weights)
    slots = _literal(
        spark,
        [(s, p.first[s], p.until[s], len(p.at[s]), p.period, i, p.start + slot) for p in plan for s in p.at for i, slot in enumerate(p.at[s])],
        ("mix_s", "mix_b0", "mix_b1", "mix_units", "mix_period", "mix_i", "mix_slot0"),
    )
    before = Window.partitionBy("mix_source").orderBy("mix_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("mix_source", "mix_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("mix_start"))
    local = F.row_number().over(Window.partitionBy("mix_source", "mix_part").orderBy("mix_uid")) - 1
    rank = F.col("mix_start") + F.col("mix_local")
    ranked = (
        rows.withColumn("mix_local", local)
        .join(starts, ["mix_source", "mix_part"])
        .withColumns({"mix_block": F.floor(rank / block), "mix_in": rank % block})
    )
    j, units = F.col("mix_block") - F.col("mix_b0"), F.col("mix_units")
    placed = ranked.join(  # (sources + 1) * W rows at most: a parameter's size
        F.broadcast(slots),
        (F.col("mix_source") == F.col("mix_s"))
        & (F.col("mix_block") >= F.col("mix_b0"))
        & (F.col("mix_block") < F.col("mix_b1"))
        & (j % units == F.col("mix_i")),
    ).withColumn("mix_slot", F.col("mix_slot0") + F.floor(j / units) * F.col("mix_period"))
    short = _short(have, plan, block)
    gone = sum((F.when(F.col("mix_slot") > slot, missing).otherwise(0) for slot, missing in short), F.lit(0))
    return placed.select(
        *docs.columns,
        "mix_source",
        "mix_block",
        "mix_slot",
        (F.col("mix_slot") * block + F.col("mix_in") - gone).cast("long").alias("mix_position"),
    )


def _literal(spark: SparkSession, rows: list[tuple], names: tuple[str, ...]) -> DataFrame:
    """rows (a string and numbers each) as a table that is part of the plan."""
    quoted = lambda x: f"{x}L" if isinstance(x, int) else "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"
    values = ", ".join("(" + ", ".join(map(quoted, r)) + ")" for r in rows or [("", *[0] * (len(names) - 1))])
    return spark.sql(f"select * from values {values} as t({', '.join(names)})").where(F.lit(bool(rows)))


def _short(have: dict[str, int], plan: list[Phase], block: int) -> list[tuple[int, int]]:
    """Slot and missing rows of each source's last block, where it is short."""
    out = []
    for s, n in have.items():
        if n % block:
            j = (n - 1) // block
            p = next(p for p in plan if s in p.at and p.first[s] <= j < p.until[s])
            q, i = divmod(j - p.first[s], len(p.at[s]))
            out.append((p.start + q * p.period + p.at[s][i], block - n % block))
    return out


def mixed_order(docs: DataFrame, **how) -> DataFrame:
    """docs in mixed order, with their own columns only. The rows are sorted over all partitions."""
    return mix(docs, **how).sort("mix_position").select(*docs.columns)
