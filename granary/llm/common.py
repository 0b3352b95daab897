"""What the operators of this subpackage share: inputs, cut points and group ids."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder. Only with a local master, and only where none is named (as in tests), a local one is made."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.conf.get("spark.master", "").startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = getattr(spark, "_granary_dir", None) or "file://" + tempfile.mkdtemp(prefix="granary-")
        spark._granary_dir = at
    return at


@contextlib.contextmanager
def _shuffles_end_with_query(spark: SparkSession) -> Iterator[None]:
    """A query that begins inside frees its shuffle files when it ends, not when the driver's garbage is collected."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def _path(spark: SparkSession, at: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def cut(df: DataFrame, name: str = "cut", narrow: bool = False) -> DataFrame:
    """Write df to the shared folder and read it back: what follows no longer depends on df's lineage,
    and a lost executor costs a re-read, not a recomputation. The files go with release(), or when the JVM ends.
    narrow: df comes out of a shuffle with a few numbers a row, for which an eighth of the files will do."""
    spark = df.sparkSession
    if narrow:
        df = df.coalesce(max(1, partitions(spark) // 8))
    at = f"{shared_dir(spark)}/granary-{name}-{uuid.uuid4().hex}"
    with _shuffles_end_with_query(spark):
        df.write.parquet(at)
    path, fs = _path(spark, at)
    fs.deleteOnExit(path)
    out = spark.read.schema(df.schema).parquet(at)
    out._granary_path = at
    for made in _open.get():
        made.append(at)
    return out


_open: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("granary tables", default=())


@contextlib.contextmanager
def tables_made() -> Iterator[list[str]]:
    """The folders of the tables that cut() writes inside."""
    made: list[str] = []
    token = _open.set((*_open.get(), made))
    try:
        yield made
    finally:
        _open.reset(token)


def release_unread(spark: SparkSession, tables: list[str], reader: DataFrame) -> list[str]:
    """Delete those of the tables (folders) that reader does not read; the others are returned."""
    read = reader.inputFiles() if tables else []
    parts = {part for file in read for part in file.split("/")}
    kept = [at for at in tables if at.rpartition("/")[2] in parts]
    for at in tables:
        if at not in kept:
            path, fs = _path(spark, at)
            fs.delete(path, True)
    return kept


def release(*dfs: DataFrame) -> None:
    """Delete the files of DataFrames that cut() returned and that nothing reads any more."""
    for df in dfs:
        path, fs = _path(df.sparkSession, df._granary_path)
        fs.delete(path, True)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
