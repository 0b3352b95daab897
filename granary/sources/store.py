"""Write-once partitions of Parquet files with a record of what was written.

A partition is claimed by creating a file in its folder, which only one writer can do; it is never written again. Its record lists every file
with its SHA-256 and a digest of the rows that does not depend on their order or files. Reading checks the files first.
"""

from __future__ import annotations

import json
import secrets
import uuid
from dataclasses import asdict, dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Tampered(Exception):
    """A partition's files are not those that were written."""


@dataclass(frozen=True)
class Record:
    id: str
    uri: str
    rows: int
    logical_digest: str
    files: tuple[tuple[str, str], ...]  # name, SHA-256
    schema: str
    written_at: str
    writer: str

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> Record:
        d = json.loads(text)
        return cls(**(d | {"files": tuple(map(tuple, d["files"]))}))


def new_id(now: datetime) -> str:
    """A UUID of version 7 (RFC 9562): 48 bits of Unix time in milliseconds, then random bits. Sorts by time; not derived from the content."""
    value = int(now.timestamp() * 1000) << 80 | 7 << 76 | secrets.randbits(12) << 64 | 2 << 62 | secrets.randbits(62)
    return str(uuid.UUID(int=value))


def logical_digest(df: DataFrame) -> str:
    """The same for the same rows in any order and layout: sums of two row hashes and the number of rows."""
    cols = sorted(df.columns)
    row = F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    h = [F.sum(F.xxhash64(row, F.lit(seed)).cast("decimal(38,0)")) for seed in (1, 2)]
    n, a, b = df.agg(F.count("*"), *h).first()
    return f"{n}-{int(a or 0) % 2**64:016x}-{int(b or 0) % 2**64:016x}"


def _fs(spark: SparkSession, uri: str):
    return spark._jvm.org.apache.hadoop.fs.Path(uri).getFileSystem(spark._jsc.hadoopConfiguration())


def _hashes(spark: SparkSession, uri: str) -> tuple[tuple[str, str], ...]:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(uri)
    rows = files.select(F.element_at(F.split("path", "/"), -1), F.sha2("content", 256)).collect()  # one row a file
    return tuple(sorted((r[0], r[1]) for r in rows))


def write(df: DataFrame, root: str, writer: str, now: datetime | None = None) -> Record:
    spark, now = df.sparkSession, now or datetime.now(UTC)
    pid = new_id(now)
    uri = f"{root.rstrip('/')}/{pid}"
    fs = _fs(spark, uri)
    fs.create(spark._jvm.org.apache.hadoop.fs.Path(f"{uri}/claim"), False).close()  # only one writer can create it
    data = f"{uri}/data"
    df.write.mode("errorifexists").option("compression", "zstd").option("parquet.block.row.count.limit", "100000").parquet(data)
    written = spark.read.parquet(data)
    digest = logical_digest(written)
    record = Record(pid, uri, int(digest.split("-")[0]), digest, _hashes(spark, data), written.schema.json(), now.isoformat(), writer)
    out = fs.create(spark._jvm.org.apache.hadoop.fs.Path(f"{uri}/record.json"), False)
    out.write(record.to_json().encode())
    out.close()
    return record


def verify(spark: SparkSession, record: Record) -> None:
    found = _hashes(spark, f"{record.uri}/data")
    if found != record.files:
        raise Tampered(f"{record.id}: {len(set(record.files) ^ set(found))} files differ")


def read(spark: SparkSession, record: Record) -> DataFrame:
    from pyspark.sql.types import StructType

    verify(spark, record)
    return spark.read.schema(StructType.fromJson(json.loads(record.schema))).parquet(f"{record.uri}/data")


@dataclass(frozen=True)
class Run:
    """What a run has written. Adding gives a new run; a partition is read only through the run that names it."""

    id: str
    records: tuple[Record, ...] = ()

    def __post_init__(self):
        if len({r.id for r in self.records}) < len(self.records):
            raise ValueError("a partition is named twice")

    def add(self, record: Record) -> Run:
        return Run(self.id, (*self.records, record))

    def read(self, spark: SparkSession, pid: str) -> DataFrame:
        named = [r for r in self.records if r.id == pid]
        if not named:
            raise KeyError(f"run {self.id} names no partition {pid}")
        return read(spark, named[0])
