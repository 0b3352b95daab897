"""Delimited text: the dialect from the first line, all columns as text, and a strict check of the encoding."""

from __future__ import annotations

import codecs
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What Spark's own reader takes; any other encoding that Python knows is decoded line by line.
OWN = ("utf-8", "us-ascii", "ascii", "iso-8859-1", "utf-16", "utf-16-be", "utf-16-le", "utf-32")
DELIMITERS = (",", ";", "\t", "|")


def sniff(spark: SparkSession, path: str) -> str:
    """The delimiter that is most frequent in the first line outside of quotes; ties go to the first of DELIMITERS."""
    first = spark.read.text(path).head()
    line, quoted, seen = (first[0] if first else ""), False, dict.fromkeys(DELIMITERS, 0)
    for ch in line:
        quoted ^= ch == '"'
        if not quoted and ch in seen:
            seen[ch] += 1
    return max(DELIMITERS, key=lambda d: seen[d])


def read(spark: SparkSession, path: str, delimiter: str | None = None, encoding: str = "UTF-8") -> DataFrame:
    """Every column a string, names stripped, nothing inferred; an empty or lacking field is an empty string. An input without a line gives
    a table without columns or rows. Of an encoding that Spark's reader refuses each line is decoded (a byte that does not fit
    becomes U+FFFD; see undecodable) and a field holds no line break."""
    first = spark.read.text(path).head()
    if first is None:
        return spark.createDataFrame([], "")
    sep = delimiter or sniff(spark, path)
    if encoding.lower() in OWN:
        df = spark.read.option("header", True).option("sep", sep).option("encoding", encoding).csv(path)
    else:
        lines = decoded(spark, path, encoding)
        head = decoded(spark, path, encoding, first_only=True).head()[0]
        names = [f.strip('"') for f in spark.range(1).select(F.split(F.lit(head), f"\\Q{sep}\\E")).head()[0]]
        plain = ", ".join(f"c{k} string" for k in range(len(names)))
        parsed = F.from_csv("line", F.lit(plain), {"sep": sep})
        df = lines.where(F.col("line") != head).select(parsed.alias("f")).select("f.*").toDF(*names)  # the header of each file goes
    return df.toDF(*(c.strip().lstrip("﻿") for c in df.columns)).na.fill("")


def decoded(spark: SparkSession, path: str, encoding: str, first_only: bool = False) -> DataFrame:
    """line: each line, decoded in Python in Arrow batches. Large files are read in splits. The encoding must have a line feed
    of one byte, as all single-byte encodings and most East Asian ones have."""
    codec = _ascii_like(encoding)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [codec.decode(x.as_py() or b"", "replace")[0].removesuffix("\r") for x in batch.column("raw")]
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["line"])

    raw = spark.read.option("lineSep", "\n").text(path)
    raw = (raw.limit(1) if first_only else raw).select(F.col("value").cast("binary").alias("raw"))
    return raw.mapInArrow(run, "line string").where("line <> ''")


def _ascii_like(encoding: str) -> codecs.CodecInfo:
    codec = codecs.lookup(encoding)  # LookupError if Python has none of this name
    if codec.encode("\n")[0] != b"\n":
        raise ValueError(f"{encoding}: lines cannot be told before they are decoded")
    return codec


def undecodable(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """path, bytes, at, reason: the files under path that are not valid in the encoding, and where each first fails (at: bytes before it). Lines
    are checked in splits of the files; only of the files at fault, whose place is asked for, is the beginning read in
    pieces. Contents are never shown."""
    codec = _ascii_like(encoding)

    def faulty(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bad = []
            for x in batch.column("raw"):
                try:
                    codec.decode(x.as_py() or b"", "strict")
                    bad.append(False)
                except UnicodeDecodeError:
                    bad.append(True)
            yield batch.filter(pa.array(bad, pa.bool_())).select(["path", "bytes"])

    lines = spark.read.option("lineSep", "\n").text(path)
    found = lines.select(F.col("value").cast("binary").alias("raw"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes"))
    files = found.mapInArrow(faulty, "path string, bytes long").distinct().collect()  # one row a file at fault
    rows = [(r.path, r.bytes, *_first_fault(spark, r.path, encoding)) for r in files]
    return spark.createDataFrame(rows, "path string, bytes long, at long, reason string")


def _first_fault(spark: SparkSession, uri: str, encoding: str, piece: int = 1 << 20) -> tuple[int | None, str | None]:
    """How many bytes stand before the first one that does not fit, and why it does not."""
    path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    decoder, done = codecs.getincrementaldecoder(encoding)("strict"), 0
    try:
        while True:
            held = len(decoder.getstate()[0])
            data = bytes(stream.readNBytes(piece))
            try:
                decoder.decode(data, final=not data)
            except UnicodeDecodeError as e:
                return done - held + e.start, e.reason
            done += len(data)
            if not data:
                return None, None
    finally:
        stream.close()


def probe(df: DataFrame, instant_column: str | None = None) -> DataFrame:
    """One row of one scan: rows, parsed instants and the latest of them."""
    from ..functions.text import iso_instant

    at = iso_instant(F.col(instant_column)) if instant_column else F.lit(None).cast("timestamp")
    return df.agg(F.count("*").alias("rows"), F.count(at).alias("parsed"), F.max(at).alias("latest"))


def age_hours(latest, now):
    """Hours from an instant to another that is given, so that a report can be made again."""
    return (F.unix_micros(now) - F.unix_micros(latest)) / 3.6e9
