"""Metadata tables: every column read as text, headers trimmed, numbers coerced where they are used."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colophon.functions import text as T


def read_metadata(spark: SparkSession, path: str, corpus: str) -> DataFrame:
    """A sheet saved as CSV.  All columns stay text; a row number keeps the order of the file for ``last row wins``."""
    raw = spark.read.csv(path, header=True, multiLine=True, escape='"')
    named = raw.toDF(*[c.strip() for c in raw.columns])
    return named.withColumn("corpus", F.lit(corpus)).withColumn("row_seq", F.monotonically_increasing_id())


def shape_metadata(raw: DataFrame, precedence: str = "schutte") -> DataFrame:
    """Typed rows, without those that have no whole number as id.

    The id column is ``schuttenr`` where that exists, also if it is empty in a row, else ``schutte_nr``.  ``precedence`` names the reading of
    a year that counts before the other; zero and nothing are missing.
    """
    have = set(raw.columns)
    col = lambda name: F.col(name) if name in have else F.lit(None).cast("string")
    number = T.whole_number(col("schuttenr") if "schuttenr" in have else col("schutte_nr"))
    first, second = ("schutte", "derived") if precedence == "schutte" else ("derived", "schutte")
    year = lambda which: F.coalesce(F.nullif(T.whole_number(col(f"{first}_{which}")), F.lit(0)), F.nullif(T.whole_number(col(f"{second}_{which}")), F.lit(0)))
    text = lambda *names: T.fallback(*[col(n) for n in names])
    return raw.select(
        "corpus", "row_seq", number.alias("schutte_nr"), text("name").alias("name"), text("givenname").alias("givenname"), text("intraposition", "Intraposition").alias("intraposition"), text("postposition", "Postposition").alias("postposition"),
        year("beginjaar").alias("beginjaar"), year("eindjaar").alias("eindjaar"), text("schutte_functie", "functie").alias("functie"), text("category").alias("category"), text("start").alias("start"), text("url", "hyperlink").alias("url"),
        T.whole_number(col("pagenr")).alias("pagenr"), T.whole_number(col("startregel")).alias("startregel"),
    ).where("schutte_nr is not null")
