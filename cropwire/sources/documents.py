"""Landed documents: write, scan (batch or stream) and the response status gate."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns of a listing of files; ``content`` is only read where it is selected.
_FILE_SCHEMA = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def land_documents(docs: DataFrame, path: str, fmt: str = "parquet", mode: str = "append") -> None:
    """Land fetched documents as rows ``(key, doc_seq, http_status, raw)``.

    Many small documents belong in a columnar table, not one file each.
    """
    docs.write.mode(mode).format(fmt).save(path)


def scan_documents(spark: SparkSession, path: str, key: str, fmt: str = "parquet",
                   schema: str | None = None, stream: bool = False, max_files: int | None = None) -> DataFrame:
    """Scan landed documents, as a batch or as a stream.

    ``fmt`` is ``parquet`` / ``json`` (rows with ``key, doc_seq, http_status,
    raw``) or ``wholetext`` (one JSON document per file, the key being the file
    name without extension, arrival order the file's modification time).
    ``max_files`` bounds the files of a micro-batch of a stream.
    """
    reader = spark.readStream if stream else spark.read
    if stream and max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if fmt == "wholetext":
        df = reader.format("text").option("wholetext", True).load(path)
        name = F.col("_metadata.file_name")
        return df.select(
            F.regexp_replace(name, r"\.[^.]*$", "").alias(key),
            F.unix_millis(F.col("_metadata.file_modification_time")).alias("doc_seq"),
            F.lit(200).alias("http_status"),
            F.col("value").alias("raw"),
        )
    if schema is None:
        schema = f"{key} STRING, doc_seq BIGINT, http_status INT, raw STRING"
    return reader.schema(schema).format(fmt).load(path)


@dataclass
class Landed:
    """Landed documents whose unreadable files and lines are told instead of failing the scan.

    ``docs``: the rows that could be read, with ``file`` and, for JSON lines,
    ``unreadable`` (the text of a line that is no JSON, else NULL). ``files``:
    every listed ``file`` with the ``rows`` it declares (NULL where it declares none).
    """
    docs: DataFrame
    files: DataFrame

    def unreadable_files(self, read: DataFrame) -> DataFrame:
        """``(file, rows, found)`` of the files that gave no row or fewer than they declare.

        ``read``: ``file`` and ``found``, the rows that were really read of it. An empty file is no fault.
        """
        return (self.files.join(read, "file", "left").withColumn("found", F.coalesce("found", F.lit(0)))
                .filter(F.when(F.col("rows").isNotNull(), F.col("found") < F.col("rows")).otherwise(F.col("found") == 0)))


def landed_files(spark: SparkSession, path: str | list[str], stream: bool = False, max_files: int | None = None, archive: str | None = None) -> DataFrame:
    """``(path, file, length)`` of the files under ``path``, as a listing or as a stream of newly landed ones; no content is read.

    ``file`` is the name that ``_metadata.file_path`` has for it. A stream hands out at most
    ``max_files`` files at a time; with ``archive`` it moves files there once their batch is done.
    """
    reader = (spark.readStream if stream else spark.read).format("binaryFile").schema(_FILE_SCHEMA)
    if stream and max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if stream and archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(path).select("path", F.col("_metadata.file_path").alias("file"), "length")


def exact_path(path: str) -> str:
    """A path for a reader, which would take some characters for a pattern."""
    return re.sub(r"([\\*?{}\[\]])", r"\\\1", path)


def scan_landed(spark: SparkSession, path: str | list[str], key: str, fmt: str = "parquet", schema: str | None = None) -> Landed:
    """``scan_documents`` as a batch over a folder or a list of files, with each file a fault domain of its own.

    A file that cannot be read, or only in part, gives the rows it has; which files those were is told by
    ``unreadable_files`` from the numbers of rows that Parquet footers declare and those that came.
    """
    schema = schema or f"{key} STRING, doc_seq BIGINT, http_status INT, raw STRING"
    reader = spark.read.option("ignoreCorruptFiles", True)
    listed = landed_files(spark, path)
    file = F.col("_metadata.file_path").alias("file")
    if fmt == "parquet":
        docs = reader.schema(schema).parquet(*_paths(path)).select("*", file)
        # No column is read here, only footers.
        declared = reader.schema(schema).parquet(*_paths(path)).groupBy(file).agg(F.count(F.lit(1)).alias("rows"))
        return Landed(docs, _without_empty_parquet(spark, listed.join(declared, "file", "left")))
    unknown = listed.filter("length > 0").select("file", F.lit(None).cast("bigint").alias("rows"))
    if fmt == "wholetext":
        docs = reader.option("wholetext", True).text(_paths(path)).select(
            F.regexp_replace("_metadata.file_name", r"\.[^.]*$", "").alias(key),
            F.unix_millis(F.col("_metadata.file_modification_time")).alias("doc_seq"),
            F.lit(200).alias("http_status"), F.col("value").alias("raw"), file)
        return Landed(docs, unknown)
    docs = (reader.schema(f"{schema}, unreadable STRING").option("columnNameOfCorruptRecord", "unreadable")
            .format(fmt).load(_paths(path)).select("*", file))
    return Landed(docs, unknown)


def _paths(path: str | list[str]) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def _without_empty_parquet(spark: SparkSession, files: DataFrame) -> DataFrame:
    """``(file, rows)``: of the files without a declared row, those that end like a Parquet file are just empty."""
    silent = [r["path"] for r in files.filter(F.col("rows").isNull() & (F.col("length") > 0)).select("path").collect()]
    out = files.filter("length > 0").select("file", "rows")
    if not silent:  # as a rule
        return out
    tails = (spark.read.format("binaryFile").load([exact_path(p) for p in silent])
             .filter(F.col("content").substr(F.col("length").cast("int") - 3, F.lit(4)) == F.lit(b"PAR1")))
    return out.join(tails.select(F.col("_metadata.file_path").alias("file")), "file", "left_anti")


def status_fault(http_status: Column, raw: Column) -> Column:
    """Reason text for a rejected response, NULL when accepted (2xx with a body)."""
    ok = http_status.between(200, 299)
    return (
        F.when(http_status.isNull() | ~ok, F.concat(F.lit("http_"), F.coalesce(http_status.cast("string"), F.lit("unknown"))))
        .when(raw.isNull(), F.lit("empty_body"))
    )


def status_gate(docs: DataFrame) -> DataFrame:
    """Docs with ``accepted`` and ``status_reason`` columns (both sides kept)."""
    reason = status_fault(F.col("http_status"), F.col("raw"))
    return docs.withColumn("status_reason", reason).withColumn("accepted", F.col("status_reason").isNull())
