"""Ordered rule tables: the first rule that matches names the line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colophon.functions import text as T
from colophon.operators import carry

# fixed values: patterns of lines at the margin
AT_MARGIN = [
    ("blank", r"^$"),
    ("page_number", r"^\s*\d+\s*$"),
    ("footnote", r"^(\d+[a-z]?)\.\s{2,}(.+)"),
    ("period_header", r"^\d{4}"),
]
BL_FOOTNOTE = r"^(\d+[a-z]?)\s([A-Z\w].+)"
ENTRY = r"^\d+\.\s{1,8}[A-Z(]"


def first_rule(text: Column, rules: list[tuple[str, str]], default: Column | None = None) -> Column:
    out = None
    for name, pattern in rules:
        out = F.when(text.rlike(pattern), name) if out is None else out.when(text.rlike(pattern), name)
    return out if default is None else out.otherwise(default)


def margin_zone(text: Column, corpus: Column) -> Column:
    later = F.when((corpus == "bl") & text.rlike(BL_FOOTNOTE), "footnote").when(text.rlike(ENTRY), "lemma_entry").otherwise("chapter_intro")
    return first_rule(text, AT_MARGIN, later)


def classify_lines(lines: DataFrame, part: list[str], order: list[str], line: str = "line") -> DataFrame:
    """zone, text, indent, fn_nr and fn_text of every line of a page.

    Bands of indentation name a line; one far to the right that is no number goes on with the zone before it.  A note at the margin
    whose next content line is indented is an entry after all.
    """
    df = lines.withColumn("indent", T.indent(F.col(line))).withColumn("text", T.strip(F.col(line)))
    far, number = F.col("indent") > 12, F.col("text").rlike(r"^\d+$")
    own = (
        F.when(F.col("text") == "", "blank").when(F.col("indent") == 0, margin_zone(F.col("text"), F.col("corpus"))).when(F.col("indent") <= 5, "body").when(F.col("indent") <= 8, "genealogy")
        .when(F.col("indent") <= 12, "sub_note").when(number, "page_number")
    )
    df = df.withColumn("_own", own)
    passing = F.when(~F.col("_own").isin("blank", "page_number"), F.col("_own"))
    df = carry.carry_forward(df, passing, "_before", part, order, own=False)
    df = df.withColumn("zone", F.coalesce("_own", "_before", F.lit("body")))
    content = F.when(~F.col("zone").isin("blank", "page_number"), F.col("indent"))
    df = carry.look_ahead(df, content, "_next", part, order)
    note = (F.col("indent") == 0) & (F.col("_own") == "footnote")
    dotted = F.col("text").rlike(AT_MARGIN[2][1])
    key = F.when(dotted, F.regexp_extract("text", AT_MARGIN[2][1], 1)).otherwise(F.regexp_extract("text", BL_FOOTNOTE, 1))
    rest = F.when(dotted, F.regexp_extract("text", AT_MARGIN[2][1], 2)).otherwise(F.regexp_extract("text", BL_FOOTNOTE, 2))
    return df.withColumns({"fn_nr": F.when(note, key), "fn_text": F.when(note, rest), "zone": F.when(note & (F.col("_next") >= 5), "lemma_entry").otherwise(F.col("zone"))}).drop("_own", "_before", "_next")


# fixed values: works that a line of references begins with
REFERENCES = (
    r"^(N\.N?\.B\.W\.|Van der Aa|Nagtglas|Elias|N\.P\.|N\.A\.|N\.L\.|Jb\.|Wap\.|Boreel|Engelbrecht|De Haan\b|Dek,|"
    r"Van Limburg Brouwer|Feenstra|Leemans|Sicco van Goslinga,)"
)


def type_lines(lines: DataFrame, part: list[str], order: str, text: str = "text", own_nr: str = "schutte_nr") -> DataFrame:
    """loopbaan, personalia, bronnen, noot, hoofd or paginahoofd for every line of an entry.

    Page heads and numbered lines leave the state alone; an opener sets personalia, references and headings reset it.
    """
    t = F.col(text)
    numbered = t.rlike(r"^\d+\.\s{2,}")
    fixed = (
        F.when(t.rlike(r"^\d+\s{5,}"), "paginahoofd").when(numbered & (F.regexp_extract(t, r"^(\d+)", 1).try_cast("int") == F.col(own_nr)), "loopbaan").when(numbered, "noot")
        .when(t.rlike(REFERENCES), "bronnen").when(t.rlike("^(Zoon van|Dochter van)"), "personalia").when(t.rlike(r"^\d{4}(-\d{4})?\s+\w"), "hoofd")
    )
    df = lines.withColumn("_fixed", fixed)
    event = F.when(F.col("_fixed") == "personalia", "personalia").when(F.col("_fixed").isin("bronnen", "hoofd"), "loopbaan")
    df = carry.carry_forward(df, event, "_state", part, [order])
    return df.withColumn("type", F.coalesce("_fixed", "_state", F.lit("loopbaan"))).drop("_fixed", "_state")


# fixed values: lines of an index
SEE_ALSO = r"(?i)^(.+?),?\s+zie(?:\s+ook)?\s+(.+)$"
WITH_NUMBER = r"^(.+?)\s+\((\d+)\)\s+(.+)$"
WITH_PAGES = r"^([A-Za-zÀ-öø-ÿ.,\s()*'\-/]+?)\s+(\d[\d\s,/]*)$"
SKIPPED = r"^(<\?xml|INDEX|Alleen|waar zij|\s*[A-Z]\s*$)"


def _named(before: Column) -> Column:
    """The name before its pages, without the comma that parts them."""
    return F.regexp_replace(F.trim(before), ",+$", "")


def parse_person_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """kind, name, nr, pages and see_also of every line of a person index; lines that are none are dropped."""
    t = F.col(line)
    see = t.rlike(SEE_ALSO) & ~F.regexp_extract(t, SEE_ALSO, 2).rlike(r"\d")
    kind = F.when(see, "see").when(t.rlike(WITH_NUMBER), "entry").when(t.rlike(WITH_PAGES), "mention").when(t.rlike("[A-Za-z]"), "bare")
    df = lines.where((t != "") & ~t.rlike(SKIPPED)).withColumn("kind", kind).where("kind is not null")
    k = F.col("kind")
    name = F.when(k == "see", F.regexp_extract(t, SEE_ALSO, 1)).when(k == "entry", F.regexp_extract(t, WITH_NUMBER, 1)).when(k == "mention", _named(F.regexp_extract(t, WITH_PAGES, 1))).otherwise(t)
    pages = F.when(k == "entry", F.regexp_extract(t, WITH_NUMBER, 3)).when(k == "mention", F.regexp_extract(t, WITH_PAGES, 2)).otherwise("")
    return df.withColumns({"name": F.trim(name), "nr": F.when(k == "entry", F.regexp_extract(t, WITH_NUMBER, 2).try_cast("int")), "pages": T.page_list(pages), "see_also": F.when(k == "see", F.trim(F.regexp_extract(t, SEE_ALSO, 2)))})


# fixed value
PLACE_SEE = r"(?i)^(.+?),?\s+zie\s+(.+)$"


def parse_place_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """As for persons, without numbers; the target of a reference keeps its ``ook``, and a line without pages is dropped."""
    t = F.col(line)
    see = t.rlike(PLACE_SEE) & ~F.regexp_extract(t, PLACE_SEE, 2).rlike(r"\d")
    df = lines.where((t != "") & ~t.rlike(SKIPPED)).withColumn("kind", F.when(see, "see").when(t.rlike(WITH_PAGES), "mention")).where("kind is not null")
    k = F.col("kind")
    return df.withColumns({"place": F.when(k == "see", F.trim(F.regexp_extract(t, PLACE_SEE, 1))).otherwise(_named(F.regexp_extract(t, WITH_PAGES, 1))), "pages": T.page_list(F.when(k == "mention", F.regexp_extract(t, WITH_PAGES, 2)).otherwise("")), "see_also": F.when(k == "see", F.trim(F.regexp_extract(t, PLACE_SEE, 2)))})
