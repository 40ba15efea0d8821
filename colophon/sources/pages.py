"""Sources: page files, index listings, hOCR, entry XML.  Each has a reader from files and a parser of a content column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colophon.functions import text as T


def read_pages(spark: SparkSession, folder: str, corpus: str, pattern: str = "*.html") -> DataFrame:
    """Page files of a corpus; the page number is the last number of the file's name."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select(F.lit(corpus).alias("corpus"), T.four_digits(F.regexp_extract("path", r"(\d+)\.\w+$", 1).try_cast("int")).alias("source_file"), "content")


def page_lines(pages: DataFrame, content: str = "content") -> DataFrame:
    """One row per line of a page, with its number; lines are cut at ``<br>``, and the last one counts though it is empty."""
    parts = F.split(T.decode_bytes(F.col(content)), "<br>", -1)
    kept = [c for c in pages.columns if c != content]
    return pages.where(F.col(content).isNotNull()).select(*kept, F.posexplode(parts).alias("line_no", "line"))


def index_lines(texts: DataFrame, text: str = "text") -> DataFrame:
    """Trimmed lines of a listing, whatever ends them."""
    kept = [c for c in texts.columns if c != text]
    return texts.where(F.col(text).isNotNull()).select(*kept, F.posexplode(F.split(text, r"\r\n|\r|\n", -1)).alias("line_no", "line")).withColumn("line", T.strip(F.col("line")))


def block_lines(raw: DataFrame, text: str = "text") -> DataFrame:
    """Lines of a marked-up segment: page tags go, breaks cut, other tags go, empty lines drop."""
    kept = [c for c in raw.columns if c != text]
    parts = F.split(F.regexp_replace(text, r"</?page[^>]*>", ""), r"\s*<br\s*/?>\s*", -1)
    lines = F.filter(F.transform(parts, lambda x: T.strip(F.regexp_replace(x, r"<[^>]*>", ""))), lambda x: x != "")
    return raw.select(*kept, F.posexplode(lines).alias("line_no", "line"))


def split_at_starts(texts: DataFrame, text: str = "text") -> DataFrame:
    """Segments from each start mark to the next; what stands before the first is dropped, and of equal numbers the last wins."""
    kept = [c for c in texts.columns if c != text]
    parts = texts.select(*kept, F.posexplode(F.split(F.regexp_replace(text, r"</root>\s*$", ""), r"(?=<start )", -1)).alias("seq", "segment"))
    marked = parts.where(F.col("segment").startswith("<start ")).withColumn("schutte_nr", F.regexp_extract("segment", r'schuttenr="(\d+)"', 1).try_cast("int")).where("schutte_nr is not null")
    return marked.groupBy(*kept, "schutte_nr").agg(F.max_by("segment", "seq").alias("segment"))


# fixed values: marks of hOCR
LINE_MARK = "class='ocr_line'"
WORD = r"class='ocrx_word'[^>]*title='[^']*x_wconf\s+(\d+)[^']*'>([^<]+)<"


def hocr_lines(pages: DataFrame, content: str = "content") -> DataFrame:
    """Lines of hOCR pages with their left edge and words (text, confidence).

    A chunk runs from one line mark to the next and takes in what stands between; one that begins in the right two fifths of the page, or
    has no box or no words, is dropped.
    """
    kept = [c for c in pages.columns if c != content]
    width = F.coalesce(F.regexp_extract(content, r"class='ocr_page'[^>]*title='[^>]*bbox 0 0 (\d+)", 1).try_cast("int"), F.lit(9999))
    chunks = F.split(F.col(content), LINE_MARK, -1)
    df = pages.select(*kept, width.alias("page_width"), F.posexplode(F.slice(chunks, F.lit(2), F.greatest(F.size(chunks) - 1, F.lit(0)))).alias("line_no", "chunk"))
    confs, texts = F.regexp_extract_all("chunk", F.lit(WORD), F.lit(1)), F.regexp_extract_all("chunk", F.lit(WORD), F.lit(2))
    words = F.filter(F.transform(F.arrays_zip(texts.alias("text"), confs.alias("conf")), lambda w: F.struct(F.trim(w["text"]).alias("text"), w["conf"].try_cast("int").alias("conf"))), lambda w: w["text"] != "")
    df = df.withColumn("x", F.regexp_extract("chunk", r'title="bbox (\d+)\s+\d+\s+(\d+)', 1).try_cast("int")).withColumn("words", words)
    df = df.where((F.col("x") <= 0.6 * F.col("page_width")) & (F.size("words") > 0))
    return df.select(*kept, "line_no", "x", "words", F.array_join(F.transform("words", lambda w: w["text"]), " ").alias("text"))


def calibrate(lines: DataFrame, part: list[str]) -> DataFrame:
    """Indentation from the left edge: the margin is the edge at rank max(0, floor(n / 20) - 1) of the page's sorted edges."""
    edges = lines.groupBy(*part).agg(F.sort_array(F.collect_list("x")).alias("xs"))
    margin = F.get("xs", F.greatest(F.floor(F.size("xs") * 0.05).cast("int") - 1, F.lit(0)))
    off = F.col("x") - F.col("margin")
    return lines.join(edges.select(*part, margin.alias("margin")), part).withColumn("indent", F.when(off < 30, 0).when(off < 130, 5).otherwise(10))


def low_confidence(words: Column, threshold: int = 80) -> Column:
    return F.filter(words, lambda w: w["conf"] < threshold)


# entry XML

# fixed values: line types and the zones they are shown in
TYPE_ZONE = {"loopbaan": "body", "personalia": "genealogy", "bronnen": "bronnen", "hoofd": "period_header"}
LEMMA_LINE = r'<line type="([^"]*)">(.*?)</line>'


def lemma_xml_lines(docs: DataFrame, xml: str = "xml") -> DataFrame:
    """Lines of entry documents with their zone; page heads are dropped, and references keep their inner markup."""
    kept = [c for c in docs.columns if c != xml]
    types, texts = F.regexp_extract_all(xml, F.lit("(?s)" + LEMMA_LINE), F.lit(1)), F.regexp_extract_all(xml, F.lit("(?s)" + LEMMA_LINE), F.lit(2))
    rows = docs.select(*kept, F.posexplode(F.arrays_zip(types.alias("type"), texts.alias("text"))).alias("line_no", "one")).select(*kept, "line_no", "one.type", "one.text")
    zones = F.create_map(*[F.lit(x) for pair in TYPE_ZONE.items() for x in pair])
    return rows.where("type <> 'paginahoofd'").withColumn("zone", F.when(F.col("type") == "noot", "footnote").otherwise(F.coalesce(F.try_element_at(zones, F.col("type")), F.lit("body"))))
