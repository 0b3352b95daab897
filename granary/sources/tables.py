"""Tables by declaration: Spark's own readers and writers behind one closed description."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession

from . import delimited

FORMATS = ("parquet", "orc", "json", "csv", "text", "jdbc", "avro")


#: Where files may be; a path without a scheme is in the cluster's default file system.
SCHEMES = ("", "file", "hdfs", "viewfs", "s3a", "abfss", "gs")


@dataclass(frozen=True)
class Source:
    """Objects (paths, or tables for jdbc) of one format. A secret option is named as env:NAME, never stated."""

    format: str
    objects: tuple[str, ...]
    options: Mapping[str, str] = field(default_factory=dict)
    secrets: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if self.format not in FORMATS:
            raise ValueError(f"no format {self.format!r}")
        if not self.objects:
            raise ValueError("a source has at least one object")
        if self.format != "jdbc" and (odd := sorted({urlsplit(p).scheme for p in self.objects} - set(SCHEMES))):
            raise ValueError(f"no place for files: {odd}")
        if stated := [k for k, v in self.secrets.items() if not v.startswith("env:")]:
            raise ValueError(f"{stated} must be named as env:NAME")


def _resolved(source: Source, env: Mapping[str, str]) -> dict[str, str]:
    out = dict(source.options)
    for k, v in source.secrets.items():
        if v[4:] not in env:
            raise KeyError(f"{v} is not set")
        out[k] = env[v[4:]]
    return out


def read(spark: SparkSession, source: Source, env: Mapping[str, str] = os.environ) -> DataFrame:
    """The union by name of all objects; columns that some lack are null there."""
    options = _resolved(source, env)
    if source.format == "csv":
        parts = [delimited.read(spark, p, **{k: v for k, v in options.items() if k in ("delimiter", "encoding")}) for p in source.objects]
    elif source.format == "jdbc":
        parts = [spark.read.format("jdbc").options(**options).option("dbtable", t).load() for t in source.objects]
    else:
        parts = [spark.read.format(source.format).options(**options).load(p) for p in source.objects]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_stream(spark: SparkSession, source: Source, schema, env: Mapping[str, str] = os.environ, files_at_once: int = 1000) -> DataFrame:
    """New files of a file source as a stream, of the schema that is given. At most files_at_once a micro-batch."""
    if source.format == "jdbc":
        raise ValueError("a stream reads files")
    reader = spark.readStream.format(source.format).schema(schema).options(**_resolved(source, env)).option("maxFilesPerTrigger", files_at_once)
    return reduce(DataFrame.unionByName, [reader.load(p) for p in source.objects])


def write_stream(df: DataFrame, source: Source, checkpoint: str, once: bool = False):
    """Appends a stream to the single path of a file source. once: what is there now is read and the query ends."""
    if source.format == "jdbc" or len(source.objects) != 1:
        raise ValueError("writes go to one path")
    out = df.writeStream.format(source.format).options(**source.options).option("checkpointLocation", checkpoint).outputMode("append")
    return (out.trigger(availableNow=True) if once else out).start(source.objects[0])


def write(df: DataFrame, source: Source, partition_by: tuple[str, ...] = ()) -> None:
    """To the single object of a source, which must not be there yet (avro: where Spark's Avro package is installed)."""
    if len(source.objects) != 1:
        raise ValueError("writes go to one path or table")
    if source.format == "jdbc":
        df.write.mode("errorifexists").format("jdbc").options(**_resolved(source, os.environ)).option("dbtable", source.objects[0]).save()
        return
    out = df.write.mode("errorifexists").format(source.format).options(**source.options)
    (out.partitionBy(*partition_by) if partition_by else out).save(source.objects[0])
