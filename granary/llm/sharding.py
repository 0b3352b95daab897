"""Sharding by bytes: minimax contiguous partition of the groups of equal texts.

Groups lie in the order of their text's 64-bit hash. The smallest capacity for which a greedy pass needs no more than
the given number of shards is found by binary search, and the greedy cuts at that capacity are the shards' bounds.
The driver never sees all groups: it holds a histogram over hash prefixes and refines only the bins in which a cut
can still fall, until the smallest capacity is exact.

Defined cases: a null text counts as an empty one; equal texts (nulls and empty ones too, and any two texts whose
64-bit hashes meet) share a shard; an empty table gives no rows; rows may repeat and doc_id may be null; other columns
are not read.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

SHARDS = 24
FIRST_BITS, MORE_BITS = 12, 8


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """docs: doc_id, text. Returns doc_id, size, text_crc32, law, shard, slot, grown_shard (null: this law regrows
    by new cuts). Slots number a shard's rows from 0 without gaps. No text is shuffled."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = cut(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("h"),
            F.monotonically_increasing_id().alias("uid"),
        ),
        "sizes",
    ).withColumn("part", F.shiftright("uid", 33))
    groups = cut(rows.groupBy("h").agg(F.sum("size").alias("size")), "groups")
    rows = rows.withColumn("shard", shard_of(F.col("h"), cuts(groups, shards)))
    counts = rows.groupBy("part", "shard").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    local = F.row_number().over(Window.partitionBy("part", "shard").orderBy("uid")) - 1
    return (
        rows.withColumn("local", local)
        .join(starts, ["part", "shard"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("start") + F.col("local")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )


def write(docs: DataFrame, path: str, shards: int = SHARDS, files: int = 16) -> None:
    """docs (text and any columns) as Parquet folders shard=0, shard=1, ...; equal texts in the same one. A shard's rows are dealt to
    so many tasks by hash, so that no task gets a whole shard. A column named shard or __h is refused (ValueError)."""
    if clash := {"shard", "__h"} & {c.lower() for c in docs.columns}:
        raise ValueError(f"docs has columns of this operator's: {sorted(clash)}")
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.withColumn("__h", F.xxhash64(text))
    size = (F.octet_length(text) + 8).cast("long")
    groups = cut(keyed.groupBy(F.col("__h").alias("h")).agg(F.sum(size).alias("size")), "groups")
    placed = keyed.withColumn("shard", shard_of(F.col("__h"), cuts(groups, shards)))
    spread = F.pmod(F.xxhash64(*docs.columns), F.lit(files))
    placed.drop("__h").repartition("shard", spread).write.partitionBy("shard").parquet(path)


def shard_of(h: Column, bounds: list[int]) -> Column:
    """How many of the bounds are at or before h."""
    return sum(((h >= F.lit(b)).cast("int") for b in bounds), F.lit(0)).cast("int")


def cuts(groups: DataFrame, shards: int) -> list[int]:
    """groups: h, size, one row a group. The first hashes of shards 1, 2, ... (fewer if fewer shards are filled)."""
    bits, table = FIRST_BITS, _bins(groups, FIRST_BITS)
    while len(table):
        solid, size = table[:, 2] == 1, table[:, 1]
        low = _smallest(size, solid, shards, fluid=True)
        high = _smallest(size, solid, shards, fluid=False)
        first, last = _walk(size, solid, low, False, clip=True), _walk(size, solid, high, True)
        spans = [(a, max(a, b)) for a, b in zip(first[: shards - 1], last + [len(size) - 1] * shards)]
        wide = [(a, b) for a, b in spans if not solid[a : b + 1].all()]
        if not wide:  # no bin of several groups is within reach of a cut, so low equals high
            return [int(table[k, 0]) for k in _walk(size, solid, high, False)]
        bits = min(64, bits + MORE_BITS)
        table = _refined(groups, table, _merged(wide), bits)
    return []


def _bins(groups: DataFrame, bits: int) -> np.ndarray:
    """First hash, bytes and groups of each filled bin, in order. A bin with one group starts at its hash."""
    rows = (
        groups.groupBy(F.shiftright("h", 64 - bits))
        .agg(F.min("h").alias("h"), F.sum("size").alias("size"), F.count("*").alias("n"))
        .select("h", "size", "n")
        .collect()
    )
    return np.array(sorted(tuple(r) for r in rows), dtype=np.int64).reshape(-1, 3)


def _refined(groups: DataFrame, table: np.ndarray, spans: list[tuple[int, int]], bits: int) -> np.ndarray:
    ends = np.append(table[:, 0], np.iinfo(np.int64).max)
    inside = F.lit(False)
    keep = np.ones(len(table), bool)
    for a, b in spans:
        keep[a : b + 1] = False
        upto = F.col("h") < F.lit(int(ends[b + 1])) if b + 1 < len(table) else F.lit(True)
        inside = inside | ((F.col("h") >= F.lit(int(table[a, 0]))) & upto)
    new = np.concatenate([table[keep], _bins(groups.where(inside), bits)])
    return new[np.argsort(new[:, 0])]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _walk(size: np.ndarray, solid: np.ndarray, capacity: int, fluid: bool, clip: bool = False) -> list[int]:
    """The bins in or before which a greedy pass cuts. fluid: bins of several groups may be cut anywhere."""
    ends = np.cumsum(size).tolist()
    total, at, out = ends[-1], 0, []
    while at + capacity < total:
        k = bisect_right(ends, at + capacity)
        start = ends[k - 1] if k else 0
        to = at + capacity if fluid and not solid[k] else start
        if to <= at:  # a bin above the capacity
            if not clip:
                return out + [-1]
            to = at + capacity
        out.append(k)
        at = to
    return out


def _smallest(size: np.ndarray, solid: np.ndarray, shards: int, fluid: bool) -> int:
    total = int(size.sum())
    low, high = max(1, -(-total // shards)), total
    while low < high:
        mid = (low + high) // 2
        cut_at = _walk(size, solid, mid, fluid)
        if len(cut_at) < shards and -1 not in cut_at:
            high = mid
        else:
            low = mid + 1
    return low
