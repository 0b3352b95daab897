"""Exact top-k search by inner product of quantised vectors: exhaustive term-at-a-time accumulation.

A vector component is a term and its postings are the rows' values in it. For each term a query holds, the weighted
postings are added into a dense array of scores; a partition selection takes the best, and the lists of all candidate
blocks are merged. Queries and candidates meet in blocks of bounded size, each pair of blocks in a task of its own.

Defined cases: vectors that are null or hold a null or non-finite component, and rows with a null vec_id, take no part;
equal rows count once and a query's own vec_id is never its candidate; where rows of one vec_id hold different vectors, the highest
score of any of them counts, for queries and for candidates; vectors of unequal length are filled up with
zeros; equal scores go to the smaller vec_id; scores are exact or the task fails with OverflowError; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrow import longs, matrix
from .common import cut

K, QUERY_EVERY, SCALE = 5, 50, 256.0
ROWS, QUERIES, TILE = 16384, 1024, 4096


def search(vectors: DataFrame, k: int = K, every: int = QUERY_EVERY, rows: int = ROWS, queries: int = QUERIES) -> DataFrame:
    """vectors: vec_id, embedding. Returns query_id, rank, vec_id, score for the rows whose vec_id every divides."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    valid = cut(
        vectors.select("vec_id", "embedding")
        .where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
        .where(~bad)
        .distinct(),
        "vectors",
    )
    asked = F.col("vec_id") % every == 0
    n, nq = valid.agg(F.count("*"), F.count_if(asked)).first()
    row_blocks, query_blocks = max(1, -(-n // rows)), max(1, -(-nq // queries))
    own = F.xxhash64("vec_id")
    blocks = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    held = valid.select("vec_id", "embedding", F.pmod(own, F.lit(row_blocks)).cast("int").alias("r"), blocks(query_blocks).alias("q"))
    wanted = valid.where(asked).select(
        "vec_id", "embedding", blocks(row_blocks).alias("r"), F.pmod(own, F.lit(query_blocks)).cast("int").alias("q")
    )
    found = (
        wanted.groupBy("r", "q")
        .cogroup(held.groupBy("r", "q"))
        .applyInArrow(_block_search(k), "query_id long, vec_id long, score long")
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _block_search(k: int):
    def run(wanted: pa.Table, held: pa.Table) -> pa.Table:
        out = [(np.empty(0, np.int64),) * 3]
        if wanted.num_rows and held.num_rows:
            qid, q = longs(wanted["vec_id"]), np.floor(SCALE * matrix(wanted["embedding"]))
            vid, v = longs(held["vec_id"]), np.floor(SCALE * matrix(held["embedding"]))
            (qid, q, of_query), (vid, v, of_row) = _by_id(qid, q), _by_id(vid, v)
            wide = max(q.shape[1], v.shape[1])
            q, v = (np.pad(x, ((0, 0), (0, wide - x.shape[1]))) for x in (q, v))
            for a in range(0, len(qid), 64):
                first, last = of_query[a], of_query[a + 64] if a + 64 < len(qid) else len(q)
                scores = accumulate(q[first:last], v)
                if len(vid) < len(v):
                    scores = np.maximum.reduceat(scores, of_row, axis=1)
                if last - first > len(qid[a : a + 64]):
                    scores = np.maximum.reduceat(scores, of_query[a : a + 64] - first, axis=0)
                out.append(best(qid[a : a + 64], scores, vid, k))
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, zip(*out)))))

    return run


def _by_id(ids: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ids, the vectors in their order, and where each id's begin."""
    order = np.argsort(ids, kind="stable")
    ids, first = np.unique(ids[order], return_index=True)
    return ids, x[order], first


def accumulate(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Scores of all rows of v for all rows of q (whole numbers held as floats), a term at a time."""
    most = np.abs(q).max(initial=0) * np.abs(v).max(initial=0) * v.shape[1]
    kind = np.int32 if most < 2**31 else np.int64 if most < 2**62 else object
    whole = (lambda x: x.astype(kind)) if kind is not object else (lambda x: np.vectorize(int, otypes=[object])(x) if x.size else x.astype(object))
    q, terms = whole(q), np.ascontiguousarray(whole(v).T)
    scores = np.zeros((len(q), len(v)), kind)
    for at in range(0, len(v), TILE):
        part = scores[:, at : at + TILE]
        for t, weight in enumerate(q.T):
            postings = terms[t, at : at + TILE]
            rows, using = np.flatnonzero(postings), np.flatnonzero(weight)
            if len(rows) * 2 > len(postings):  # nearly all rows hold the term
                part += weight[:, None] * postings
            elif len(rows) and len(using):
                part[np.ix_(using, rows)] += weight[using, None] * postings[rows]
    if kind is object and any(abs(x) >= 2**63 for x in scores.flat):
        raise OverflowError("a score does not fit a long")
    return scores.astype(np.int64)


def best(qid: np.ndarray, scores: np.ndarray, vid: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    own = qid[:, None] == vid[None, :]
    least = np.where(own, np.iinfo(np.int64).min, scores)
    n = least.shape[1]
    bound = np.partition(least, n - k, axis=1)[:, n - k] if n > k else np.full(len(qid), np.iinfo(np.int64).min)
    i, j = np.nonzero((least >= bound[:, None]) & ~own)
    order = np.lexsort((vid[j], -least[i, j], i))
    i, j = i[order], j[order]
    nth = np.arange(len(i)) - np.searchsorted(i, i)
    i, j = i[nth < k], j[nth < k]
    return qid[i], vid[j], scores[i, j]


ORACLE = f"""
with v as (select distinct vec_id, embedding from embeddings where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
  e as (select vec_id, list_transform(embedding, lambda x: cast(floor({SCALE} * cast(x as double)) as bigint)) e from v),
  s as (select q.vec_id query_id, c.vec_id, max(cast(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) as bigint)) score
    from e q join e c on q.vec_id <> c.vec_id where q.vec_id % {QUERY_EVERY} = 0 group by all),
  r as (select *, row_number() over (partition by query_id order by score desc, vec_id) rank from s)
select query_id, cast(rank as int) rank, vec_id, score from r where rank <= {K}"""
