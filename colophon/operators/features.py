"""Feature tables that readers and pages are fed from."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colophon.functions import text as T


def search_index(entries: DataFrame) -> DataFrame:
    """One row an entry, in the order of corpus and number; the chapter as it is written."""
    year = lambda c: F.nullif(F.col(c), F.lit(0))
    rows = entries.select("corpus", "schutte_nr", F.coalesce("toc_title", F.lit("")).alias("title"), F.coalesce("toc_chapter", F.lit("")).alias("land"), year("beginjaar").alias("begin"), year("eindjaar").alias("end"), T.guarded(F.coalesce("functie", F.lit("")), 100).alias("functie"))
    return rows.orderBy("corpus", "schutte_nr")


def timeline(entries: DataFrame) -> DataFrame:
    """One row an entry with a first year, in the order of corpus, category and year; a missing last year stays missing."""
    rows = entries.where("beginjaar is not null and beginjaar <> 0")
    name = T.fallback(F.col("toc_title"), F.col("name"), F.concat(F.lit("Nr. "), F.col("schutte_nr").cast("string")))
    rows = rows.select("corpus", "schutte_nr", name.alias("name"), F.col("beginjaar").alias("start"), F.nullif(F.col("eindjaar"), F.lit(0)).alias("end"), F.coalesce("category", F.lit("")).alias("category"), F.coalesce("functie", F.lit("")).alias("functie"))
    return rows.orderBy("corpus", "category", "start", "schutte_nr")


def chapters(contents: DataFrame, entries: DataFrame) -> DataFrame:
    """The entries of the chapters of a table of contents, by first year (unknown last) and number: one row an entry with its place in the chapter, so
    that a long chapter is no single row.

    ``contents`` are (corpus, chapter, schutte_nr, title); years and roles come from ``entries``.
    """
    year = lambda c: F.nullif(F.col(c), F.lit(0))
    known = entries.groupBy("corpus", "schutte_nr").agg(F.max(F.struct("lemma_id", year("beginjaar").alias("begin"), year("eindjaar").alias("end"), T.guarded(F.coalesce("functie", F.lit("")), 80).alias("functie"))).alias("m"))
    rows = contents.where("chapter is not null and schutte_nr <> 0").join(known, ["corpus", "schutte_nr"], "left")
    place = F.row_number().over(Window.partitionBy("corpus", "chapter").orderBy(F.coalesce("m.begin", F.lit(9999)), "schutte_nr"))
    return rows.select("corpus", "chapter", T.slug(F.col("chapter")).alias("slug"), place.alias("place"), "schutte_nr", "title", "m.begin", "m.end", F.coalesce("m.functie", F.lit("")).alias("functie"))


def decade_grid(entries: DataFrame) -> DataFrame:
    """Entries per country and decade (derived: readers see it drawn)."""
    land = F.regexp_replace(F.coalesce("toc_chapter", F.lit("")), r"^[IVXLCDM]+\.\s*", "")
    return entries.where("beginjaar > 0").groupBy("corpus", land.alias("land"), (F.floor(F.col("beginjaar") / 10) * 10).cast("int").alias("decade")).agg(F.count("*").alias("n"))


def indent_histogram(lines: DataFrame) -> DataFrame:
    return lines.groupBy("corpus", "indent").agg(F.count("*").alias("n"))


def page_tails(lines: DataFrame, part: list[str], order: str, k: int = 8) -> DataFrame:
    """The last k lines of a page that are not blank."""
    over = Window.partitionBy(*part).orderBy(F.desc(order))
    return lines.where("text <> ''").withColumn("from_end", F.row_number().over(over)).where(F.col("from_end") <= k)


def sorted_by_first_year(entries: DataFrame) -> DataFrame:
    """Rank by first year, unknown last, then number and corpus."""
    # one key spans all entries, so the ranks come from a range-partitioned sort and not from one window over everything
    year = F.coalesce(F.nullif(F.col("beginjaar"), F.lit(0)), F.lit(9999))
    return entries.select("corpus", "schutte_nr", year.alias("year")).orderBy("year", "schutte_nr", "corpus")


# fixed values: what a line at the margin is taken for when the structure of pages is surveyed
SURVEYED = [("footnote", r"^\d+[a-z]?\.\s"), ("period_header", r"^\d{4}"), ("lemma_entry", r"^\d+\.\s{3,6}[A-Z]")]


def surveyed(lines: DataFrame) -> DataFrame:
    """Lines of pages that are neither blank nor a page number, with their indentation and, at the margin, what they look like."""
    rows = lines.withColumn("indent", T.indent(F.col("line"))).withColumn("text", T.strip(F.col("line"))).where((F.col("text") != "") & ~F.col("text").rlike(r"^\d+$"))
    bare = F.regexp_replace("line", f"^{T.BLANK}+", "")
    pattern = F.lit("other")
    for name, rule in reversed(SURVEYED):
        pattern = F.when(bare.rlike(rule), name).otherwise(pattern)
    return rows.withColumn("pattern", F.when(F.col("indent") == 0, pattern)).withColumn("begins", F.substring(bare, 1, 50))


def survey_patterns(rows: DataFrame) -> DataFrame:
    """How often each pattern stands at the margin, and on how many pages."""
    return rows.where("pattern is not null").groupBy("corpus", "pattern").agg(F.count("*").alias("n"), F.countDistinct("page_nr").alias("n_pages"))


def survey_pages(rows: DataFrame, pages: DataFrame) -> DataFrame:
    """Pages with and without notes at their end."""
    noted = rows.where("pattern = 'footnote'").select("corpus", "page_nr").distinct().withColumn("has", F.lit(1))
    return pages.join(noted, ["corpus", "page_nr"], "left").groupBy("corpus").agg(F.count("has").alias("with_notes"), (F.count("*") - F.count("has")).alias("without_notes"))


def note_contexts(pages: DataFrame, text: str = "text", around: int = 5) -> DataFrame:
    """Figures glued to a word before a stop or a blank, with the characters around them."""
    mark = r"[\p{L}\p{N}_]\d+[a-z]?\s*[;,.\s]"
    kept = [c for c in pages.columns if c != text]
    between, found = F.split(F.col(text), mark, -1), F.regexp_extract_all(F.col(text), F.lit(f"({mark})"))
    sizes = F.zip_with(F.slice(between, F.lit(1), F.size(found)), found, lambda b, m: F.struct(F.length(b).alias("b"), F.length(m).alias("m")))
    begun = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    starts = F.aggregate(sizes, begun, lambda acc, x: F.struct((acc["at"] + x["b"] + x["m"]).alias("at"), F.array_append(acc["out"], acc["at"] + x["b"]).alias("out")), lambda acc: acc["out"])
    rows = pages.select(*kept, text, F.posexplode(F.arrays_zip(found.alias("mark"), starts.alias("at"))).alias("pos", "m")).select(*kept, text, "pos", "m.mark", "m.at")
    begin = F.greatest(F.col("at") - around, F.lit(0))
    return rows.select(*kept, "pos", "mark", F.col(text).substr(begin + 1, F.col("at") + F.length("mark") + around - begin).alias("context"))
