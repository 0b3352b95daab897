"""Embedding near-dedup: subspace pigeonhole join.

Unit vectors are rotated by a fixed orthogonal matrix and split into blocks. Cosine c is a squared distance of
2 - 2c; a pair within it must in some block be within that block's equal share of it. Each block is range-joined: rows lie
in strips of its first coordinate as wide as the block's radius, strips are cut into pages of bounded size, and pages of
the same or neighbouring strips meet in a task, where the second coordinate (sorted) and then the block's distance leave
the candidates. Each is verified by its whole vectors in double precision, and belongs to the first block in which
it is within the share, so that no link counts twice. Tasks return counts and a forest, never all pairs.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing; vectors of
unequal length link with nothing of another length; equal vectors are one row of the join; rows that share a vec_id are
one node; a row with a null vec_id has no links and a null component; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import longs, matrix
from .common import cut
from .components import components, flatten, unite

COSINE, BLOCKS, PAGE, SLACK = 0.95, 4, 8192, 1e-5
EMIT = "id long, links long, root long"


@cache
def rotation(width: int) -> np.ndarray:
    """Orthogonal, in whole multiples of 2 ** -24 (held as whole numbers)."""
    return np.rint(np.linalg.qr(np.random.default_rng(7).standard_normal((width, width)))[0] * 2.0**24)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def turn(units: np.ndarray) -> np.ndarray:
    """Unit vectors rotated. All products are of whole numbers and no sum exceeds 2 ** 46 or so (Cauchy and Schwarz), so the
    result is exact and the same in every task, in whatever order it is added up."""
    return (np.rint(units * 2.0**22) @ rotation(units.shape[1])) * 2.0**-46


def edges(width: int) -> list[int]:
    """Where the blocks of a vector of this width begin and end. Narrow vectors have fewer blocks."""
    blocks = max(1, min(BLOCKS, width // 2))
    return [width * k // blocks for k in range(blocks + 1)]


def share(cosine: float, width: int) -> float:
    return (2 - 2 * cosine + SLACK) / (len(edges(width)) - 1)


def _prepare(cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds the strip in each block."""
        for batch in batches:
            col = batch.column("embedding")
            sizes = np.diff(col.offsets.to_numpy())
            for width in np.unique(sizes):
                use = np.flatnonzero(sizes == width)
                part = batch.take(pa.array(use))
                turned, at = turn(unit(matrix(part.column("embedding")))), edges(int(width))
                strips = np.floor(turned[:, at[:-1]] / sqrt(share(cosine, int(width)))).astype(np.int32)
                lists = pa.ListArray.from_arrays(np.arange(len(strips) + 1, dtype=np.int32) * strips.shape[1], pa.array(strips.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("id", "copies", "embedding")), lists], ["id", "copies", "embedding", "strips"]
                )

    return run


def cluster(vectors: DataFrame, cosine: float = COSINE, page: int = PAGE) -> DataFrame:
    """vectors: vec_id, embedding. Returns vec_id, n_links, component_id, kept."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.col("embedding").isNotNull() & F.col("vec_id").isNotNull() & ~bad & F.exists("embedding", lambda x: x != 0)
    valid = vectors.where(usable)
    one = cut(valid.groupBy("embedding").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")), "vectors")
    item = vectors.schema["embedding"].dataType.elementType.simpleString()
    ready = cut(
        one.select("id", "copies", "embedding").mapInArrow(
            _prepare(cosine), f"id long, copies long, embedding array<{item}>, strips array<int>"
        ),
        "strips",
    )
    met = cut(_meetings(ready, page).groupBy("width", "block", "strip", "next", "left", "right").applyInArrow(_join(cosine), EMIT), "met")
    linked = met.where("links > 0").groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(met.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")))
    named = (
        one.join(linked, "id", "left")
        .join(roots, "id", "left")
        .select("embedding", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n"), F.coalesce("root", "id").alias("root"))
    )
    joined = vectors.select("vec_id", F.when(usable, F.col("embedding")).alias("embedding")).join(named, "embedding", "left")
    return joined.select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("root", "vec_id").alias("component_id"),
    ).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def _meetings(ready: DataFrame, page: int) -> DataFrame:
    """A row for each page that a vector's page meets: its own, those of its strip and of the strips beside it.
    How many pages each strip has is bounded by the range of a coordinate, not by the rows."""
    rows = ready.select("id", "copies", "embedding", F.size("embedding").alias("width"), F.posexplode("strips").alias("block", "strip"))
    where = ["width", "block", "strip"]
    pages = cut(rows.groupBy(*where).agg(F.ceil(F.count("*") / page).cast("int").alias("pages")), "pages")
    beside = lambda by, name: pages.select("width", "block", (F.col("strip") + by).alias("strip"), F.col("pages").alias(name))
    plan = pages.join(beside(-1, "after"), where, "left").join(beside(1, "before"), where, "left").fillna(0)
    rows = rows.join(F.broadcast(plan), where)  # blocks x strips rows: unit vectors' coordinates are in [-1, 1]
    rows = rows.withColumn("own", F.pmod(F.xxhash64("id", "embedding"), F.col("pages")).cast("int"))
    upto = lambda a, n: F.when(n > a, F.sequence(a, n - 1)).otherwise(F.array().cast("array<int>"))
    zero = F.lit(0)
    meet = lambda step, left, right, side: F.struct(
        (F.col("strip") + step).cast("int").alias("strip"), F.lit(step != 0 or side > 1).alias("next"), left.alias("left"), right.alias("right"), F.lit(side % 2).alias("side")
    )
    own = F.col("own")
    there = F.concat(
        F.transform(upto(own, F.col("pages")), lambda x: meet(0, own, x, 0)),
        F.transform(upto(zero, own), lambda x: meet(0, x, own, 1)),
        F.transform(upto(zero, F.col("after")), lambda x: meet(0, own, x, 2)),
        F.transform(upto(zero, F.col("before")), lambda x: meet(-1, x, own, 3)),
    )
    out = rows.withColumn("at", F.explode(there)).select("id", "copies", "embedding", "width", "block", "at.*")
    return out


def _join(cosine: float):
    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        width, block, _, following, left, right = (k.as_py() for k in key)
        ids, copies, side = longs(t["id"]), longs(t["copies"]), longs(t["side"])
        order = np.argsort(ids, kind="stable")
        ids, copies, side = ids[order], copies[order], side[order]
        raw = unit(matrix(t["embedding"])[order])
        turned = turn(raw)
        same = not following and left == right
        a = np.arange(len(ids)) if same else np.flatnonzero(side == 0)
        b = a if same else np.flatnonzero(side == 1)
        links, parent = np.zeros(len(ids), np.int64), np.arange(len(ids))
        for i, j in _candidates(turned.astype(np.float32), a, b, edges(width), block, share(cosine, width), same):
            for at in range(0, len(i), 32768):
                x, y = i[at : at + 32768], j[at : at + 32768]
                near = np.einsum("ij,ij->i", raw[x], raw[y]) >= cosine
                x, y = x[near], y[near]
                first = _first_block(turned, x, y, edges(width), share(cosine, width)) == block
                x, y = x[first], y[first]
                np.add.at(links, x, copies[y])
                np.add.at(links, y, copies[x])
                unite(parent, x, y)
        root = flatten(parent)
        out = np.flatnonzero((links > 0) | (root != np.arange(len(ids))))
        return pa.table({"id": ids[out], "links": links[out], "root": ids[root[out]]})

    return run


def _candidates(turned, a, b, at, block, budget, same):
    """Pairs of rows within the block's share (with room for rounding), chunk by chunk. same: each pair once. turned: in
    single precision."""
    lo, hi = at[block], at[block + 1]
    second = turned[:, min(lo + 1, hi - 1)]
    a, b = a[np.argsort(second[a], kind="stable")], b[np.argsort(second[b], kind="stable")]
    reach, sorted_b = sqrt(budget) + 1e-4, second[b]
    norms = (turned[:, lo:hi] ** 2).sum(axis=1)
    for k in range(0, len(a), 256):
        x = a[k : k + 256]
        from_, to = np.searchsorted(sorted_b, [second[x[0]] - reach, second[x[-1]] + reach])
        for m in range(max(from_, k) if same else from_, to, 4096):
            y = b[m : min(m + 4096, to)]
            d2 = norms[x][:, None] + norms[y] - 2 * (turned[x, lo:hi] @ turned[y, lo:hi].T)
            i, j = np.nonzero(d2 <= budget + 1e-4)
            if same:
                keep = j + m > i + k
                i, j = i[keep], j[keep]
            if len(i):
                yield x[i], y[j]


def _first_block(turned, x, y, at, budget) -> np.ndarray:
    """The first block in which each pair is within the share. Added up in one order, whatever task asks."""
    first = np.full(len(x), -1)
    for block in range(len(at) - 1):
        d2 = np.zeros(len(x))
        for k in range(at[block], at[block + 1]):
            d = turned[x, k] - turned[y, k]
            d2 += d * d
        first[(first < 0) & (d2 <= budget)] = block
    return first


ORACLE = f"""
with recursive v as (select vec_id, cast(embedding as double[]) e from embeddings where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
  l as (select a.vec_id a, b.vec_id b from v a join v b on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
    where list_cosine_similarity(a.e, b.e) >= {COSINE}),
  r as (select vec_id id, vec_id root from v union select l.b, r.root from r join l on l.a = r.id where r.root < l.b),
  m as (select id, min(root) root from r group by id),
  n as (select a id, count(*) n from l group by a)
select vec_id, cast(coalesce(n.n, 0) as bigint) n_links, coalesce(m.root, vec_id) component_id, vec_id = coalesce(m.root, vec_id) kept
from embeddings e left join m on m.id = e.vec_id left join n on n.id = e.vec_id"""
