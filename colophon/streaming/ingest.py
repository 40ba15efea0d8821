"""Incremental ingest of page files: what was read once is not read again."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from colophon.functions import text as T


def ingest_pages(spark: SparkSession, folder: str, out: str, checkpoint: str, corpus: str, pattern: str = "*.html"):
    """Read the files that are new, append their pages to a Parquet table, and stop.  The checkpoint remembers the files."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary").option("pathGlobFilter", pattern).load(folder)
    pages = files.select(F.lit(corpus).alias("corpus"), T.four_digits(F.regexp_extract("path", r"(\d+)\.\w+$", 1).try_cast("int")).alias("source_file"), "content")
    query = pages.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def not_yet_present(wanted, present, key: str):
    """Rows of ``wanted`` without a row in ``present``: work that is still to be done."""
    return wanted.join(present.select(key).distinct(), key, "left_anti")


def stream_new_rows(spark: SparkSession, table_path: str, out: str, checkpoint: str):
    """Copy rows of a Parquet table that arrived since the last call; the schema is that of the table."""
    schema = spark.read.parquet(table_path).schema
    # a table is a file or a folder of files; the pattern finds either
    query = spark.readStream.schema(schema).parquet(f"{table_path}*").writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
