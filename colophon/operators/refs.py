"""The reference graph: page lists to entries, and entries to what mentions them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def page_references(index: DataFrame, entries: DataFrame, key: str = "person_seq") -> DataFrame:
    """(key, corpus, schutte_nr, pos): entries that begin on a page of the list, in the order of their first mention.

    Page 0 is none, pages without an entry drop out.  Repeats fall in the map-side part of the aggregation.
    """
    pages = index.select(key, "corpus", F.posexplode("pages").alias("pos", "page"))
    starts = entries.where("toc_page <> 0").select("corpus", F.col("toc_page").alias("page"), "schutte_nr")
    return pages.join(starts, ["corpus", "page"]).groupBy(key, "corpus", "schutte_nr").agg(F.min("pos").alias("pos"))


def mentioned_in(index: DataFrame, edges: DataFrame, entries: DataFrame, key: str = "person_seq") -> DataFrame:
    """(corpus, subject, schutte_nr, key, pos): where the subject of an index row is mentioned, itself left out."""
    subjects = index.where("schutte_nr is not null").select(key, "corpus", F.col("schutte_nr").alias("subject"))
    known = entries.select("corpus", F.col("schutte_nr").alias("subject")).distinct()
    return subjects.join(known, ["corpus", "subject"], "left_semi").join(edges, [key, "corpus"]).where("subject <> schutte_nr")


def ordered_distinct(rows: DataFrame, part: list[str], value: str, pos: str) -> DataFrame:
    """Distinct values by their first place."""
    return rows.groupBy(*part, value).agg(F.min(pos).alias(pos))
