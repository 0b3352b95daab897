"""A training corpus from raw documents, in stages. Each stage's result is written as Parquet and read back for the next.

STAGES holds (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the columns
of documents.

A stage's result reads tables in the shared folder, some as large as the documents. They are there until a later stage begins in the same session
and for the same sf_dir: its docs are read from the written result, and what they do not read themselves is deleted then. Two runs over one sf_dir
at once need a session each.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from granary.llm import bpe, mixing, quality, repeats, simhash
from granary.llm.common import cut, release, release_unread, table, tables_made


def judge_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of over 50 words that occur more than once go from the texts."""
    return repeats.strip(docs, words=True)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The order of documents follows the sources' target weights."""
    return mixing.mixed_order(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, mix_position, n_tokens, ids, decoded_sha256, in the order of the mix. Files read again need not keep the
    order of their rows, so the schedule is made again here and mix_position (0, 1, ...) tells each row's place."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    placed = mixing.mix(docs.select("doc_id", "source", "text")).sort("mix_position")
    return bpe.tokens(placed.select("doc_id", "source", "mix_position", "text"), path, public_tokenizers.PATTERN)


def _ends_earlier(k: int, stage: Callable) -> Callable:
    """Stage k, which first deletes what the stages before it have left (see above)."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        left: dict[tuple[str, int], list[str]] = spark.__dict__.setdefault("_granary_left", {})
        for at in [at for at in left if at[0] == sf_dir and at[1] < k]:
            left[at] = release_unread(spark, left[at], docs)
        with tables_made() as made:
            out = stage(spark, docs, sf_dir)
        left[sf_dir, k] = left.get((sf_dir, k), []) + made
        return out

    return run


_STAGES = [
    ("quality classifier", judge_quality),
    ("SimHash near-dedup", drop_copies),
    ("suffix-array dedup", cut_repeats),
    ("mixing sources", mix_sources),
    ("byte-level BPE", encode),
]
STAGES = [(name, _ends_earlier(k, stage)) for k, (name, stage) in enumerate(_STAGES)]
#: The stages train a model and run a scheduler and an encoder, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs, "stage")
            if before is not None:
                release(before)
            before = docs
    return docs
