"""Records from lines: entries over page boundaries, their periods and their notes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colophon.operators import carry

# fixed values: the zones of a record's lines
RECORD_ZONE = {"lemma_entry": "entry", "genealogy": "genealogy", "sub_note": "sub_note"}


def mark_entries(lines: DataFrame, toc: DataFrame) -> DataFrame:
    """``entry_nr``: the number of an entry line, if the table of contents announces it."""
    known = toc.where("schutte_nr is not null").select("corpus", F.col("schutte_nr").alias("entry_nr")).distinct().withColumn("_known", F.lit(True))
    numbered = lines.withColumn("entry_nr", F.when(F.col("zone") == "lemma_entry", F.regexp_extract("text", r"^(\d+)", 1).try_cast("int")))
    return numbered.join(known, ["corpus", "entry_nr"], "left").withColumn("entry_nr", F.when(F.col("_known"), F.col("entry_nr"))).drop("_known")


PAGES_A_CHUNK = 1024


def sessionize(marked: DataFrame, page: list[str], order: list[str]) -> DataFrame:
    """Every line with the record it belongs to and the period in force; lines before the first entry have none.

    Both are carried within pages, over the pages of a chunk, and over chunks, so neither the lines nor the pages of a corpus are sorted in one task.  An entry that is not announced is a line of the record
    before it.
    """
    chunk = F.floor(F.col(page[0]) / PAGES_A_CHUNK)
    df = carry.two_level_carry(marked, F.col("entry_nr"), "record_nr", ["corpus"], page, order, chunk)
    df = carry.two_level_carry(df, F.when(F.col("zone") == "period_header", F.col("text")), "period_now", ["corpus"], page, order, chunk)
    shown = F.when(F.col("entry_nr").isNotNull(), "entry").when(F.col("zone") == "genealogy", "genealogy").when(F.col("zone") == "sub_note", "sub_note").otherwise("body")
    return df.withColumn("record_zone", shown)


def record_lines(sessions: DataFrame) -> DataFrame:
    """The text lines of records: page furniture, notes and headings are none, nor are goings-on of them far to the right."""
    keep = F.col("zone").isin("lemma_entry", "body", "genealogy", "sub_note")
    return sessions.where(F.col("record_nr").isNotNull() & keep)


def record_periods(sessions: DataFrame, order: list[str]) -> DataFrame:
    """The first period that is not empty among a record's entry lines."""
    entries = sessions.where("entry_nr is not null and period_now <> ''")
    return entries.groupBy("corpus", F.col("entry_nr").alias("schutte_nr")).agg(F.min_by("period_now", F.struct(*order)).alias("period"))


def attach_notes(sessions: DataFrame, page: list[str], order: list[str]) -> DataFrame:
    """A note belongs to the record before it, a note before any to the first entry on its page, else it is lost; of equal keys the last wins."""
    own = Window.partitionBy("corpus", *page).orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    df = sessions.withColumn("owner", F.coalesce("record_nr", F.first("entry_nr", ignorenulls=True).over(own)))
    notes = df.where("zone = 'footnote' and fn_nr is not null and owner is not null")
    return notes.groupBy("corpus", F.col("owner").alias("schutte_nr"), "fn_nr").agg(F.max_by("fn_text", F.struct(*page, *order)).alias("fn_text"))


def assemble(toc: DataFrame, lines: DataFrame, notes: DataFrame, periods: DataFrame, order: list[str]) -> DataFrame:
    """Nested records, one an announced entry, also where no line was found."""
    body = lines.groupBy("corpus", F.col("record_nr").alias("schutte_nr")).agg(F.sort_array(F.collect_list(F.struct(*order, F.col("record_zone").alias("zone"), "text", "indent"))).alias("lines"))
    note = notes.groupBy("corpus", "schutte_nr").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("fn_nr", "fn_text")))).alias("footnotes"))
    key = ["corpus", "schutte_nr"]
    return toc.join(body, key, "left").join(note, key, "left").join(periods, key, "left")


def enrich(records: DataFrame, mentions: DataFrame, meta: DataFrame) -> DataFrame:
    """Nested records with their metadata and where their subject is mentioned, in the order of the index and its pages."""
    key = ["corpus", "schutte_nr"]
    places = mentions.groupBy("corpus", F.col("subject").alias("schutte_nr")).agg(F.sort_array(F.collect_list(F.struct("person_seq", "pos", F.col("schutte_nr").alias("nr")))).alias("mentioned_in"))
    return records.join(meta, key, "left").join(places, key, "left")


def display_blocks(lines: DataFrame, part: list[str], order: str, joined) -> DataFrame:
    """Neighbouring lines of a zone as one block; ``joined`` joins a block so far with its next line.  Preformatted lines stand alone."""
    numbered = carry.islands(lines, F.col("zone"), "block", part, [order], F.col("zone") == "pre_html")
    grouped = numbered.groupBy(*part, "block").agg(F.first("zone").alias("zone"), F.count("*").alias("n_lines"), F.sort_array(F.collect_list(F.struct(order, "text"))).alias("rows"))
    texts = F.transform("rows", lambda r: r["text"])
    return grouped.withColumn("text", F.aggregate(F.slice(texts, F.lit(2), F.greatest(F.size(texts) - 1, F.lit(0))), F.get(texts, 0), joined)).drop("rows")
