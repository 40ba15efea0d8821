"""Queries over pages, lines, records and their references, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colophon.functions import text as T
from colophon.operators import carry, features, joins, records, refs, roles, rules, shred
from colophon.session import cut, table, work_folder
from colophon.sources import metadata, pages, sinks
from colophon.streaming import ingest

# what the tables hold once; of re-deliveries all is equal but the time of arrival


def entries(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    df = table(spark, d, "lemma")
    return df.select("lemma_id", *columns).groupBy("lemma_id").agg(*[F.first(c).alias(c) for c in columns])


def pages_once(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "page_html").select("corpus", "page_nr", "content").dropDuplicates(["corpus", "page_nr"])


def toc_once(spark: SparkSession, d: str) -> DataFrame:
    return joins.last_wins(table(spark, d, "toc_flat"), ["corpus", "schutte_nr"], ["received_at", "item_seq"])


def index_once(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "persons_index").dropDuplicates(["person_seq"])


def printed_lines(spark: SparkSession, d: str) -> DataFrame:
    """Entries as they stood in print: a period at the margin, the lines as they were indented, then the notes."""
    df = entries(spark, d, "corpus", "schutte_nr", "toc_page", "period", "lines", "footnotes")
    # numbers above 21474 times 100,000 are no ints
    base = F.col("schutte_nr").cast("bigint") * 100000
    key = ["corpus", F.col("toc_page").alias("page_nr")]
    body = df.select(*key, base.alias("base"), F.explode("lines").alias("l")).where("l.text is not null").select("corpus", "page_nr", (F.col("base") + F.col("l.seq")).alias("line_no"), F.concat(F.repeat(F.lit(" "), F.col("l.indent")), F.col("l.text")).alias("line"))
    heads = df.where("period is not null").select(*key, base.alias("line_no"), F.col("period").alias("line"))
    notes = df.select(*key, base.alias("base"), F.explode("footnotes").alias("k", "v")).where("v is not null")
    rank = F.regexp_extract("k", r"(\d+)", 1).cast("bigint") * 30 + F.coalesce(F.ascii(F.nullif(F.regexp_extract("k", "([a-z])", 1), F.lit(""))) - 96, F.lit(0))
    notes = notes.select("corpus", "page_nr", (F.col("base") + 50000 + rank).alias("line_no"), F.concat("k", F.lit(".  "), F.replace("v", F.lit("\n"), F.lit(" "))).alias("line"))
    return body.unionByName(heads).unionByName(notes)


_ONCE = """lem as (select distinct on (lemma_id) * from lemma),
toc1 as (select * from toc_flat qualify row_number() over (partition by corpus, schutte_nr order by received_at desc, item_seq desc) = 1),
idx as (select distinct on (person_seq) * from persons_index)"""

_BLANK = r"[\s\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"

_PRINTED = f"""{_ONCE},
printed as (
  select corpus, page_nr, base + l.seq as line_no, repeat(' ', l.indent) || l.text as line from (select corpus, toc_page as page_nr, schutte_nr::bigint * 100000 as base, unnest(lines) as l from lem) where l.text is not null
  union all select corpus, toc_page, schutte_nr::bigint * 100000, period from lem where period is not null
  union all select corpus, page_nr, base + 50000 + regexp_extract(k, '(\\d+)', 1)::bigint * 30 + coalesce(ascii(nullif(regexp_extract(k, '([a-z])', 1), '')) - 96, 0), k || '.  ' || replace(v, chr(10), ' ')
    from (select corpus, toc_page as page_nr, schutte_nr::bigint * 100000 as base, unnest(map_keys(footnotes)) as k, unnest(map_values(footnotes)) as v from lem) where v is not null)"""

_ZONED = (
    _PRINTED
    + f""",
measured as (select *, length(line) - length(regexp_replace(line, '^{_BLANK}+', '')) as indent, regexp_replace(line, '^{_BLANK}+|{_BLANK}+$', '', 'g') as text from printed),
owned as (select *, case when text = '' then 'blank'
    when indent = 0 then case when regexp_matches(text, '^\\s*\\d+\\s*$') then 'page_number' when regexp_matches(text, '^(\\d+[a-z]?)\\.\\s{{2,}}(.+)') then 'footnote' when regexp_matches(text, '^\\d{{4}}') then 'period_header'
      when corpus = 'bl' and regexp_matches(text, '^(\\d+[a-z]?)\\s([A-Z\\w].+)') then 'footnote' when regexp_matches(text, '^\\d+\\.\\s{{1,8}}[A-Z(]') then 'lemma_entry' else 'chapter_intro' end
    when indent <= 5 then 'body' when indent <= 8 then 'genealogy' when indent <= 12 then 'sub_note' when regexp_matches(text, '^\\d+$') then 'page_number' end as own from measured),
carried as (select *, coalesce(own, last_value(case when own not in ('blank', 'page_number') then own end ignore nulls) over (partition by corpus, page_nr order by line_no rows between unbounded preceding and 1 preceding), 'body') as zone0 from owned),
ahead as (select *, first_value(case when zone0 not in ('blank', 'page_number') then indent end ignore nulls) over (partition by corpus, page_nr order by line_no rows between 1 following and unbounded following) as nxt from carried),
zoned as (select corpus, page_nr, line_no, line, text, indent,
    case when indent = 0 and own = 'footnote' and nxt >= 5 then 'lemma_entry' else zone0 end as zone,
    case when indent = 0 and own = 'footnote' then case when regexp_matches(text, '^(\\d+[a-z]?)\\.\\s{{2,}}(.+)') then regexp_extract(text, '^(\\d+[a-z]?)\\.\\s{{2,}}(.+)', 1) else regexp_extract(text, '^(\\d+[a-z]?)\\s([A-Z\\w].+)', 1) end end as fn_nr,
    case when indent = 0 and own = 'footnote' then case when regexp_matches(text, '^(\\d+[a-z]?)\\.\\s{{2,}}(.+)') then regexp_extract(text, '^(\\d+[a-z]?)\\.\\s{{2,}}(.+)', 2) else regexp_extract(text, '^(\\d+[a-z]?)\\s([A-Z\\w].+)', 2) end end as fn_text from ahead)"""
)

_SESSIONS = (
    _ZONED
    + """,
marked as (select z.*, t.schutte_nr as entry_nr from zoned z left join (select distinct corpus, schutte_nr from toc1) t on z.zone = 'lemma_entry' and z.corpus = t.corpus and try_cast(regexp_extract(z.text, '^(\\d+)', 1) as int) = t.schutte_nr),
sessions as (select *, last_value(entry_nr ignore nulls) over (partition by corpus order by page_nr, line_no rows between unbounded preceding and current row) as record_nr,
    last_value(case when zone = 'period_header' then text end ignore nulls) over (partition by corpus order by page_nr, line_no rows between unbounded preceding and current row) as period_now,
    case when entry_nr is not null then 'entry' when zone in ('genealogy', 'sub_note') then zone else 'body' end as record_zone from marked)"""
)

PAGE, LINE = ["page_nr"], ["line_no"]


def _zones(spark, d):
    return rules.classify_lines(printed_lines(spark, d), ["corpus", "page_nr"], LINE)


def _sessions(spark, d):
    return records.sessionize(records.mark_entries(_zones(spark, d), toc_once(spark, d)), PAGE, LINE)


def page_lines(spark, d):
    df = pages.page_lines(pages_once(spark, d))
    return df.select("corpus", "page_nr", "line_no", T.indent(F.col("line")).alias("indent"), F.md5("line").alias("line_md5"))


def page_text(spark, d):
    text = T.html_text(T.decode_bytes(F.col("content")))
    df = pages_once(spark, d).where("content is not null").select("corpus", "page_nr", text.alias("t"))
    return df.select("corpus", "page_nr", F.when(F.col("t") == "", 0).otherwise(F.size(F.split("t", "\n"))).alias("n_lines"), F.md5("t").alias("text_md5"))


def decoded_pages(spark, d):
    """Pages read by the encoding they declare, else as UTF-8, else as cp1252."""
    return pages_once(spark, d).where("content is not null").select("corpus", "page_nr", F.md5(T.decode_declared(F.col("content"))).alias("text_md5"))


def page_zones(spark, d):
    df = rules.classify_lines(pages.page_lines(pages_once(spark, d)), ["corpus", "page_nr"], LINE)
    return df.groupBy("corpus", "zone").agg(F.count("*").alias("n"))


def line_zones(spark, d):
    return _zones(spark, d).select("corpus", "page_nr", "line_no", "indent", "zone", "fn_nr")


def record_lines(spark, d):
    df = records.record_lines(_sessions(spark, d))
    return df.select("corpus", F.col("record_nr").alias("schutte_nr"), "page_nr", "line_no", "record_zone", F.md5("text").alias("text_md5"))


def record_periods(spark, d):
    return records.record_periods(_sessions(spark, d), ["page_nr", "line_no"])


def record_notes(spark, d):
    return records.attach_notes(_sessions(spark, d), PAGE, LINE)


def _nested(spark, d):
    # lines, notes and periods are three aggregates of the same sessions
    s = cut(_sessions(spark, d))
    toc = toc_once(spark, d).select("corpus", "schutte_nr", "title", "chapter")
    return records.assemble(toc, records.record_lines(s), records.attach_notes(s, PAGE, LINE), records.record_periods(s, ["page_nr", "line_no"]), ["page_nr", "line_no"])


def records_nested(spark, d):
    """Nested records; their lines and notes are shown as fingerprints."""
    lines = F.array_join(F.transform("lines", lambda x: F.concat_ws("|", x["zone"], x["indent"].cast("string"), x["text"])), "\n")
    notes = F.array_join(F.transform(F.array_sort(F.map_entries("footnotes")), lambda x: F.concat_ws("|", x["key"], x["value"])), "\n")
    return _nested(spark, d).select("corpus", "schutte_nr", "title", "period", F.coalesce(F.size("lines"), F.lit(0)).alias("n_lines"), F.md5(lines).alias("lines_md5"), F.coalesce(F.size("footnotes"), F.lit(0)).alias("n_notes"), F.md5(notes).alias("notes_md5"))


def records_enriched(spark, d):
    """Nested records with metadata and mentions: lines, notes and places of mention in one row."""
    meta = joins.last_wins(entries(spark, d, "corpus", "schutte_nr", "name", "beginjaar", "eindjaar"), ["corpus", "schutte_nr"], ["lemma_id"]).drop("lemma_id")
    df = records.enrich(_nested(spark, d), mentioned_in(spark, d), meta)
    mentions = F.array_join(F.transform("mentioned_in", lambda x: F.concat_ws(":", x["person_seq"].cast("string"), x["pos"].cast("string"), x["nr"].cast("string"))), ",")
    return df.select("corpus", "schutte_nr", "title", "chapter", "period", "name", "beginjaar", "eindjaar", F.coalesce(F.size("lines"), F.lit(0)).alias("n_lines"), F.coalesce(F.size("footnotes"), F.lit(0)).alias("n_notes"), F.md5(F.coalesce(mentions, F.lit(""))).alias("mentions_md5"))


def zone_carry(spark, d):
    own = F.when(F.col("event_type") != "view", F.col("event_type"))
    return carry.carry_forward(table(spark, d, "events"), own, "state", ["user_id"], ["ts", "event_id"]).select("event_id", "state")


def lookahead_reclass(spark, d):
    df = carry.look_ahead(table(spark, d, "events"), F.when(F.col("event_type") != "view", F.col("value")), "next_value", ["user_id"], ["ts", "event_id"])
    return df.select("event_id", F.when((F.col("event_type") == "click") & (F.col("next_value") >= 10), "entry").otherwise(F.col("event_type")).alias("kind"))


def carry_two_level(spark, d):
    df = table(spark, d, "events").select("event_id", "ts", "event_type", F.to_date("ts").alias("day"), F.lit(1).alias("all"))
    out = carry.two_level_carry(df, F.when(F.col("event_type") == "signup", F.col("event_id")), "record_id", ["all"], ["day"], ["ts", "event_id"], F.trunc("day", "month"))
    return out.select("event_id", "record_id")


def islands(spark, d):
    df = carry.islands(table(spark, d, "events"), F.col("event_type"), "block", ["user_id"], ["ts", "event_id"], F.col("event_type") == "error")
    return df.groupBy("user_id", "block").agg(F.min("event_type").alias("event_type"), F.count("*").alias("n"), F.min("event_id").alias("first_event"))


def display_blocks(spark, d):
    lines = entries(spark, d, "lines").select("lemma_id", F.explode("lines").alias("l")).select("lemma_id", "l.zone", "l.text", "l.seq").where("text is not null")
    joined = lambda a, b: F.when(a.endswith("-"), T.join_hyphen(a, b)).otherwise(F.concat_ws(" ", a, b))
    return records.display_blocks(lines, ["lemma_id"], "seq", joined)


def trim_trailing(spark, d):
    lines = entries(spark, d, "lines").select("lemma_id", F.explode("lines").alias("l")).select("lemma_id", "l.zone", "l.seq")
    df = carry.trim_trailing(lines, F.coalesce(F.col("zone"), F.lit("")) == "sub_note", ["lemma_id"], "seq")
    return df.groupBy("lemma_id").agg(F.count("*").alias("n"), F.max("seq").alias("last_seq"))


def _typed(spark, d):
    text = entries(spark, d, "corpus", "schutte_nr", "text").where("text is not null").select("lemma_id", "corpus", "schutte_nr", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "text"))
    return rules.type_lines(text.where("text <> ''"), ["lemma_id"], "line_no")


def line_types(spark, d):
    return _typed(spark, d).select("lemma_id", "line_no", "type", F.md5("text").alias("text_md5"))


def prev_next(spark, d):
    df = entries(spark, d, "corpus", "schutte_nr")
    return carry.neighbours(df.select("corpus", "schutte_nr").distinct(), "schutte_nr", ["corpus"])


def toc_chapters(spark, d):
    """Any depth: an item without a number names the chapter of those after it."""
    items = shred.shred_items(table(spark, d, "toc"), wide=True)
    chapter = F.when((F.col("schutte_nr") == 0) & (F.coalesce("title", F.lit("")) != ""), F.col("title"))
    df = carry.carry_forward(items, chapter, "chapter", ["toc_id"], ["item_seq"])
    return df.where("schutte_nr <> 0").select("toc_id", "item_seq", "schutte_nr", F.regexp_replace("title", r"^\d+\.\s+", "").alias("title"), "chapter", F.coalesce(F.trim("page_number").try_cast("int"), F.lit(0)).alias("page_nr"), F.when(F.col("page_source").isNull(), "0001").otherwise(F.coalesce(T.four_digits(F.trim("page_source").try_cast("int")), T.zero_filled(F.col("page_source"), 4))).alias("source_file"))


def toc_levels(spark, d, direct: bool = False):
    """By written level: level 0 opens a chapter, level 1 is an entry of it, others are passed over.

    ``direct`` takes only the items right under the root, as in a flat table of contents; else nesting is unfolded first.
    """
    items = shred.shred_items(table(spark, d, "toc"), wide=True)
    items = items.where("depth = 1") if direct else items
    df = carry.carry_forward(items, F.when(F.col("level") == 0, F.struct("item_seq", "title")), "head", ["toc_id"], ["item_seq"])
    df = df.where("level = 1 and schutte_nr <> 0 and head is not null")
    return df.select("toc_id", "item_seq", "schutte_nr", "title", F.col("head.item_seq").alias("chapter_seq"), F.col("head.title").alias("chapter"), T.slug(F.col("head.title")).alias("slug"))


def toc_join(spark, d):
    found = entries(spark, d, "corpus", "schutte_nr", "lines").groupBy("corpus", "schutte_nr").agg(F.max(F.coalesce(F.size("lines"), F.lit(0))).alias("n_lines"))
    return toc_once(spark, d).select("corpus", "schutte_nr", "title").join(found, ["corpus", "schutte_nr"], "left").withColumn("n_lines", F.coalesce("n_lines", F.lit(0)))


def overlay(spark, d):
    base = toc_once(spark, d).select("corpus", "schutte_nr", "title", "chapter")
    better = entries(spark, d, "corpus", "schutte_nr", "toc_title", "toc_chapter").groupBy("corpus", "schutte_nr").agg(F.max("toc_title").alias("title"), F.max("toc_chapter").alias("chapter"))
    return joins.overlay(base, better, ["corpus", "schutte_nr"], ["title", "chapter"], lambda c: F.coalesce(c, F.lit("")) != "")


def meta_last_wins(spark, d):
    df = joins.last_wins(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return df.select("o_custkey", "o_orderkey", "o_orderstatus")


def year_precedence(spark, d):
    """Two readings of a year, in either precedence; zero and nothing count as missing."""
    df = entries(spark, d, "corpus", "schutte_nr", "beginjaar", "period")
    read = T.whole_number(F.regexp_extract("period", r"^(\d{4})", 1))
    own = F.nullif(F.col("beginjaar"), F.lit(0))
    return df.select("lemma_id", F.coalesce(read, own).alias("period_first"), F.coalesce(own, read).alias("year_first"))


def _edges(spark, d):
    return refs.page_references(index_once(spark, d).select("person_seq", "corpus", "pages"), entries(spark, d, "corpus", "schutte_nr", "toc_page").select("corpus", "schutte_nr", "toc_page").distinct())


def page_refs(spark, d):
    return _edges(spark, d)


def mentioned_in(spark, d):
    known = entries(spark, d, "corpus", "schutte_nr")
    out = refs.mentioned_in(index_once(spark, d).select("person_seq", "corpus", "schutte_nr"), _edges(spark, d), known)
    return out.select("corpus", "subject", "schutte_nr", "person_seq", "pos")


def ordered_distinct(spark, d):
    rows = index_once(spark, d).select("person_seq", F.posexplode("pages").alias("pos", "page"))
    return refs.ordered_distinct(rows.where("page is not null"), ["person_seq"], "page", "pos")


def person_lines(spark, d):
    docs = table(spark, d, "documents").where("source = 'person_index'").select("doc_id", "text")
    df = rules.parse_person_lines(pages.index_lines(docs))
    return df.select("doc_id", "line_no", "kind", "name", "nr", F.array_join(F.transform("pages", lambda p: p.cast("string")), ",").alias("pages"), "see_also")


def place_lines(spark, d):
    docs = table(spark, d, "documents").where("source = 'geo_index'").select("doc_id", "text")
    df = rules.parse_place_lines(pages.index_lines(docs))
    return df.select("doc_id", "line_no", "kind", "place", F.array_join(F.transform("pages", lambda p: p.cast("string")), ",").alias("pages"), "see_also")


def role_index(spark, d):
    return roles.role_index(roles.roles(entries(spark, d, "corpus", "schutte_nr", "beginjaar", "functie")))


def role_persons(spark, d):
    """The persons of every role, in order."""
    rows = roles.role_persons(roles.roles(entries(spark, d, "corpus", "schutte_nr", "name", "givenname", "intraposition", "beginjaar", "eindjaar", "category", "functie")))
    year = lambda c: F.nullif(F.col(c), F.lit(0))
    return rows.select("role_key", "place", "role", "corpus", "schutte_nr", T.full_name(F.col("givenname"), F.col("intraposition"), F.col("name")).alias("name"), year("beginjaar").alias("begin"), year("eindjaar").alias("end"), F.coalesce("category", F.lit("")).alias("category"))


def chapters(spark, d):
    """The chapters of the register of contents with their entries."""
    contents = toc_once(spark, d).select("corpus", "chapter", "schutte_nr", F.coalesce("full_title", F.lit("")).alias("title"))
    return features.chapters(contents, entries(spark, d, "corpus", "schutte_nr", "beginjaar", "eindjaar", "functie"))


def persons_sorted(spark, d):
    """The index of persons by name."""
    return index_once(spark, d).select("name", "person_seq", "corpus", "schutte_nr").orderBy("name", "person_seq")


def places_sorted(spark, d):
    """The index of places by name."""
    return place_lines(spark, d).select("place", "doc_id", "line_no", "pages").orderBy("place", "doc_id", "line_no")


def search_index(spark, d):
    return features.search_index(entries(spark, d, "corpus", "schutte_nr", "toc_title", "toc_chapter", "beginjaar", "eindjaar", "functie"))


def timeline(spark, d):
    return features.timeline(entries(spark, d, "corpus", "schutte_nr", "toc_title", "name", "beginjaar", "eindjaar", "category", "functie"))


def decade_grid(spark, d):
    return features.decade_grid(entries(spark, d, "corpus", "toc_chapter", "beginjaar"))


def corpus_counts(spark, d):
    """The corpora and the index as one table of counts."""
    a = entries(spark, d, "corpus").groupBy("corpus").agg(F.count("*").alias("n")).withColumn("what", F.lit("entries"))
    b = index_once(spark, d).groupBy("corpus").agg(F.count("*").alias("n")).withColumn("what", F.lit("persons"))
    c = pages_once(spark, d).groupBy("corpus").agg(F.count("*").alias("n")).withColumn("what", F.lit("pages"))
    listed = table(spark, d, "documents").where("source = 'geo_index'").select("corpus", "text")
    e = rules.parse_place_lines(pages.index_lines(listed)).groupBy("corpus").agg(F.count("*").alias("n")).withColumn("what", F.lit("places"))
    return a.unionByName(b).unionByName(c).unionByName(e)


def _surveyed(spark, d):
    return features.surveyed(pages.page_lines(pages_once(spark, d)))


def survey_patterns(spark, d):
    return features.survey_patterns(_surveyed(spark, d))


def survey_pages(spark, d):
    return features.survey_pages(_surveyed(spark, d), pages_once(spark, d).where("content is not null").select("corpus", "page_nr"))


def survey_anomalies(spark, d):
    """Lines at the margin that look like nothing known."""
    return _surveyed(spark, d).where("pattern = 'other'").select("corpus", "page_nr", "line_no", "begins")


def note_contexts(spark, d):
    """Figures glued to words in the texts of entries, with what stands around them."""
    return features.note_contexts(entries(spark, d, "text").where("text is not null"))


def paired_pages(spark, d):
    """The k-th page of one corpus beside the k-th of the other."""
    both = {c: pages_once(spark, d).where(F.col("corpus") == c).select(F.lit(1).alias("all"), "page_nr", F.col("page_nr").alias(c)) for c in ("nl", "bl")}
    return joins.pair_in_order(both["nl"], both["bl"], ["all"], "page_nr").select("k", "nl", "bl")


def indent_histogram(spark, d):
    return features.indent_histogram(pages.page_lines(pages_once(spark, d)).withColumn("indent", T.indent(F.col("line"))))


def page_tails(spark, d):
    df = pages.page_lines(pages_once(spark, d)).withColumn("text", T.strip(F.col("line")))
    return features.page_tails(df, ["corpus", "page_nr"], "line_no").select("corpus", "page_nr", "from_end", "line_no")


def first_by_year(spark, d):
    return features.sorted_by_first_year(entries(spark, d, "corpus", "schutte_nr", "beginjaar")).limit(20)


def verify_status(spark, d):
    expected = toc_once(spark, d).where("deleted_at is null").select("corpus", "schutte_nr", "page_nr")
    present = entries(spark, d, "corpus", "schutte_nr", "toc_page", "text").groupBy("corpus", "schutte_nr").agg(F.max("toc_page").alias("toc_page"), F.max(F.col("text").isNotNull()).alias("has_text"))
    return joins.verify(expected, present, ["corpus", "schutte_nr"], F.col("has_text"), F.col("toc_page") == F.col("page_nr")).select("corpus", "schutte_nr", "status")


def verify_report(spark, d):
    return verify_status(spark, d).groupBy("corpus", "status").agg(F.count("*").alias("n"), F.min("schutte_nr").alias("first_nr"))


def title_lookup(spark, d):
    titles = toc_once(spark, d).select("corpus", "schutte_nr", "title")
    df = entries(spark, d, "corpus", "schutte_nr", "name").join(titles, ["corpus", "schutte_nr"], "left")
    return df.select("lemma_id", T.fallback(F.col("title"), F.col("name"), F.concat(F.lit("Nr. "), F.col("schutte_nr").cast("string"))).alias("title"))


def assembled_names(spark, d):
    df = entries(spark, d, "schutte_nr", "name", "givenname", "intraposition")
    return df.select("lemma_id", T.full_name(F.col("givenname"), F.col("intraposition"), F.col("name")).alias("full_name"), T.four_digits(F.col("schutte_nr")).alias("nr"))


def _citation(n):
    numeral = F.element_at(F.array(*[F.lit(x) for x in ("IV", "ïv", "lT", "XI", "IIII", "X", "II", "VIII")]), (F.pmod(n, F.lit(8)) + 1).cast("int"))
    return F.concat(F.lit("zie N.N.B.W. "), numeral, F.lit(", "), n.cast("string"), F.lit("; Van der Aa XII, 1, "), n.cast("string"))


def _cited(spark, d):
    """Texts of entries with citations after them, in all the spellings above."""
    return entries(spark, d, "schutte_nr", "text").select("lemma_id", F.concat(F.coalesce("text", F.lit("")), F.lit("\n"), _citation(F.col("schutte_nr"))).alias("text"))


def roman_links(spark, d):
    return _cited(spark, d).select("lemma_id", F.md5(T.link_citations(F.col("text"))).alias("linked_md5"))


def loose_links(spark, d):
    text = F.concat("text", F.lit("; van der Aa, Biogr. Woordenb. der Nederlanden, dl. 007, 12 en A.a., biogr woordenb., IX, 3; Aa, Biogr. Woordenb.; nnbw iv, 9"))
    return _cited(spark, d).select("lemma_id", F.md5(T.link_citations_loosely(text)).alias("linked_md5"))


def entry_links(spark, d):
    """Citations in the whole texts and notes of entries, in both forms: how many links each value gets."""
    df = entries(spark, d, "text", "footnotes")
    values = df.select("lemma_id", F.lit("").alias("note"), F.col("text").alias("value")).unionByName(df.select("lemma_id", F.explode("footnotes").alias("note", "value"))).where("value is not null")
    count = lambda c: F.size(F.regexp_extract_all(c, F.lit(r"(<a href=\"https://example\.org/)")))
    return values.select("lemma_id", "note", count(T.link_citations(F.col("value"))).alias("n_links"), count(T.link_citations_loosely(F.col("value"))).alias("n_loose"))


def inline_markup(spark, d):
    df = entries(spark, d, "corpus", "text", "footnotes").where("text is not null")
    return df.select("lemma_id", T.inline_markup(F.col("text"), F.col("corpus"), F.map_keys("footnotes")).alias("html"))


def number_links(spark, d):
    """Texts of entries in which numbered references are links."""
    df = entries(spark, d, "corpus", "schutte_nr", "text").where("text is not null")
    text = F.concat(T.escape_html(F.col("text")), F.lit(" (zie sub nr.  "), F.col("schutte_nr").cast("string"), F.lit("), nr."), F.col("lemma_id").cast("string"))
    return df.select("lemma_id", F.md5(T.link_numbers(text, F.col("corpus"))).alias("html_md5"))


def inline_notes(spark, d):
    """Note keys glued to words in the texts of entries."""
    df = entries(spark, d, "schutte_nr", "text").where("text is not null")
    text = F.concat("text", F.lit(" rapport"), F.col("schutte_nr").cast("string"), F.lit("a en brief12a3, x10000b en (zie)7"))
    return df.select("lemma_id", F.array_join(T.inline_notes(text), ",").alias("notes"))


def page_hyphens(spark, d):
    """Lines of entries that end in a hyphen, joined with the next."""
    lines = entries(spark, d, "lines").select("lemma_id", F.explode("lines").alias("l")).select("lemma_id", "l.seq", "l.text").where("text is not null")
    ahead = carry.look_ahead(lines, F.col("text"), "following", ["lemma_id"], ["seq"])
    return ahead.where("text like '%-' and length(text) > 1 and following is not null").select("lemma_id", "seq", T.join_hyphen(F.col("text"), F.col("following")).alias("joined"))


def entry_xml(spark, d):
    typed = _typed(spark, d)
    meta = joins.last_wins(entries(spark, d, "corpus", "schutte_nr", "name", "givenname", "beginjaar", "eindjaar", "functie"), ["corpus", "schutte_nr"], ["lemma_id"]).drop("lemma_id")
    return sinks.lemma_xml(typed, meta, "line_no").select("corpus", "schutte_nr", F.md5("xml").alias("xml_md5"))


def entry_xml_lines(spark, d):
    """Entry documents read back: what was typed is found again."""
    typed = _typed(spark, d)
    bare = typed.select("corpus", "schutte_nr").distinct().selectExpr("*", *[f"cast(null as string) as {c}" for c in ("name", "givenname", "beginjaar", "eindjaar", "functie")])
    return pages.lemma_xml_lines(sinks.lemma_xml(typed, bare, "line_no")).groupBy("corpus", "schutte_nr", "zone").agg(F.count("*").alias("n"))


def corpus_pages(spark, d):
    df = printed_lines(spark, d).withColumn("text", T.strip(F.col("line")))
    return sinks.corpus_xml(df, ["corpus", "page_nr"], "line_no").select("corpus", "page_nr", F.md5("xml").alias("xml_md5"))


def start_locations(spark, d):
    lines = entries(spark, d, "corpus", "schutte_nr", "lines").select((F.col("lemma_id") * 1000).alias("base"), F.explode("lines").alias("l")).where("l.text is not null").select((F.col("base") + F.col("l.seq")).alias("seq"), "l.text")
    starts = entries(spark, d, "lines").select("lemma_id", F.get("lines", F.lit(0))["text"].alias("start")).where("start is not null")
    return joins.locate_starts(lines, starts, "lemma_id", "seq", flexible=True).drop("found")


def start_fragments(spark, d):
    """Places of texts from within first lines and of texts that run over their end."""
    lines = entries(spark, d, "lines").select("lemma_id", F.explode("lines").alias("l")).select((F.col("lemma_id") * 1000 + F.col("l.seq")).alias("seq"), "l.text").where("text is not null")
    starts = entries(spark, d, "lines").select("lemma_id", F.get("lines", F.lit(0))["text"].alias("one"), F.get("lines", F.lit(1))["text"].alias("two"))
    over = F.concat(F.substring("one", 11, 1000), F.lit("\n"), F.substring("two", 1, 8))
    starts = starts.select("lemma_id", F.when(F.col("lemma_id") % 2 == 0, over).otherwise(F.substring("one", 5, 24)).alias("start"))
    return joins.locate_starts(lines, starts, "lemma_id", "seq").drop("found")


def tagged_starts(spark, d):
    """Lines of entries in which the starts of entries are wrapped in their marks."""
    # the lines are read five times
    once = cut(entries(spark, d, "lines"))
    lines = once.select("lemma_id", F.explode("lines").alias("l")).select((F.col("lemma_id") * 1000 + F.col("l.seq")).alias("seq"), "l.text").where("text is not null")
    starts = once.select("lemma_id", F.substring(F.get("lines", F.lit(0))["text"], 5, 24).alias("start"))
    located = joins.locate_starts(lines, joins.untagged(starts, lines, "lemma_id"), "lemma_id", "seq")
    return sinks.tagged_lines(lines, located.withColumnRenamed("lemma_id", "schutte_nr"), "seq").where(F.col("text").contains("<start ")).select("seq", "text")


def segments(spark, d):
    """Marked texts cut at their marks again."""
    df = entries(spark, d, "corpus", "schutte_nr", "text").where("text is not null")
    one = F.concat(F.lit('<start schuttenr="'), F.col("schutte_nr").cast("string"), F.lit('">x</start>'), F.replace("text", F.lit("\n"), F.lit("<br>")))
    raw = df.groupBy("corpus", F.floor(F.col("schutte_nr") / 10).alias("part")).agg(F.concat(F.lit("<root>"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("schutte_nr", "lemma_id", one.alias("x")))), lambda r: r["x"]), ""), F.lit("</root>")).alias("text"))
    parts = pages.split_at_starts(raw).withColumnRenamed("segment", "text")
    own = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_no", "line"))), lambda r: r["line"]), "\n")
    return pages.block_lines(parts).groupBy("corpus", "schutte_nr").agg(F.count("*").alias("n_lines"), F.md5(own).alias("lines_md5"))


def _hocr(spark, d):
    df = entries(spark, d, "lines").where("size(lines) > 0")
    conf = lambda w: (F.lit(60) + F.pmod(F.length(w) * 7, F.lit(40))).cast("string")
    words = lambda t: F.array_join(F.transform(F.filter(F.split(t, " "), lambda w: w != ""), lambda w: F.concat(F.lit("<span class='ocrx_word' title='bbox 0 0 1 1; x_wconf "), conf(w), F.lit("'>"), w, F.lit("</span>"))), " ")
    line = lambda r: F.concat(F.lit("<span class='ocr_line' title=\"bbox "), (F.lit(100) + r["indent"] * 50).cast("string"), F.lit(" 1 900 20\">"), words(F.coalesce(r["text"], F.lit(""))), F.lit("</span>"))
    body = F.array_join(F.transform(F.array_sort("lines", lambda a, b: a["seq"] - b["seq"]), line), "\n")
    return df.select("lemma_id", F.concat(F.lit("<div class='ocr_page' title='image; bbox 0 0 1000 1400'>\n"), body, F.lit("</div>")).alias("content"))


def hocr_lines(spark, d):
    df = pages.calibrate(pages.hocr_lines(_hocr(spark, d)), ["lemma_id"])
    return df.select("lemma_id", "line_no", "x", "indent", "text", F.size(pages.low_confidence(F.col("words"))).alias("low"))


def _both_readings(spark, d):
    """The page text of an entry and its hOCR, paired by key: those without the other are passed over."""
    html = entries(spark, d, "text").where("text is not null").select("lemma_id", T.html_text(F.replace("text", F.lit("\n"), F.lit("<br>"))).alias("a"))
    lines = pages.hocr_lines(_hocr(spark, d))
    hocr = lines.groupBy("lemma_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_no", "text"))), lambda r: r["text"]), "\n").alias("b"), F.sum(F.size(pages.low_confidence(F.col("words")))).alias("low_conf"))
    return html.join(hocr, "lemma_id")


def ocr_quality(spark, d):
    """Both readings of an entry side by side: how alike they are, the lines of one only, and words read with low confidence."""
    diff = _both_readings(spark, d).select("lemma_id", "low_conf", F.round(T.similarity("a", "b"), 6).alias("similarity"), T.line_difference("a", "b").alias("d"))
    return diff.select("lemma_id", "similarity", F.size("d.only_left").alias("only_left"), F.size("d.only_right").alias("only_right"), "low_conf")


def ocr_lines(spark, d):
    """Lines and words of low confidence of both readings of an entry."""
    n = lambda c: F.when(F.col(c) == "", 0).otherwise(F.size(F.split(c, "\n")))
    return _both_readings(spark, d).select("lemma_id", n("a").alias("html_lines"), n("b").alias("hocr_lines"), "low_conf")


def repaired_rounds(spark, d):
    df = entries(spark, d, "name").where("name is not null")
    return df.select("lemma_id", F.when(F.col("name").rlike(r"[^\x00-\x7f]"), T.repair_rounds("name")).otherwise(F.col("name")).alias("name"), F.length(T.garble(T.garble("name"))).alias("garbled_length"))


def streamed_pages(spark, d):
    """Pages through the incremental ingest: a second run finds nothing new."""
    folder = work_folder(spark, "pages")
    for _ in range(2):
        ingest.stream_new_rows(spark, f"{d}/page_html.parquet", f"{folder}/out", f"{folder}/state")
    return spark.read.parquet(f"{folder}/out").groupBy("corpus").agg(F.count("*").alias("n"), F.max("page_nr").alias("last_page"))


def metadata_rows(spark, d):
    """Entries written as a sheet of text, shaped again; later rows of an entry win."""
    df = entries(spark, d, "corpus", "schutte_nr", "name", "givenname", "beginjaar", "eindjaar", "functie", "category")
    sheet = df.select("corpus", F.col("lemma_id").alias("row_seq"), F.concat(F.col("schutte_nr").cast("string"), F.lit(".0")).alias("schuttenr"), "name", "givenname", F.col("beginjaar").cast("string").alias("schutte_beginjaar"), F.lit("0").alias("derived_beginjaar"), F.col("eindjaar").cast("string").alias("derived_eindjaar"), F.col("functie").alias("schutte_functie"), "category")
    shaped = joins.last_wins(metadata.shape_metadata(sheet, "derived"), ["corpus", "schutte_nr"], ["row_seq"])
    return shaped.select("corpus", "schutte_nr", "name", "givenname", "beginjaar", "eindjaar", "functie", "category").orderBy("corpus", "schutte_nr")


def new_pages(spark, d):
    """Pages that the index names and that are not there yet."""
    wanted = index_once(spark, d).select("corpus", F.explode("pages").alias("page")).distinct().select("corpus", F.concat_ws("/", "corpus", T.four_digits(F.col("page"))).alias("file"))
    present = pages_once(spark, d).select(F.concat_ws("/", "corpus", T.four_digits(F.col("page_nr"))).alias("file"))
    return ingest.not_yet_present(wanted, present, "file").select("corpus", "file")


QUERIES = {
    f.__name__: f
    for f in (
        page_lines, page_text, page_zones, line_zones, record_lines, record_periods, record_notes, records_nested, zone_carry, lookahead_reclass, carry_two_level, islands, display_blocks, trim_trailing, line_types, prev_next,
        toc_chapters, toc_levels, toc_join, overlay, meta_last_wins, year_precedence, page_refs, mentioned_in, ordered_distinct, person_lines, place_lines, role_index, chapters, search_index, timeline, decade_grid, corpus_counts,
        indent_histogram, page_tails, first_by_year, verify_status, verify_report, title_lookup, assembled_names, roman_links, loose_links, entry_links, inline_markup, inline_notes, page_hyphens, entry_xml, corpus_pages, start_locations, start_fragments, segments,
        decoded_pages, records_enriched, role_persons, persons_sorted, places_sorted, survey_patterns, survey_pages, survey_anomalies, note_contexts, paired_pages, number_links, entry_xml_lines, tagged_starts, ocr_lines,
        hocr_lines, ocr_quality, repaired_rounds, streamed_pages, metadata_rows, new_pages,
    )
}

_PAGES = """pg as (select distinct on (corpus, page_nr) corpus, page_nr, content from page_html),
decoded as (select corpus, page_nr, coalesce(try(decode(content)), array_to_string(list_transform(regexp_extract_all(hex(content), '..'), lambda h: chr(('0x' || h)::int)), '')) as t from pg where content is not null),
plines as (select corpus, page_nr, unnest(string_split(t, '<br>')) as line, unnest(range(len(string_split(t, '<br>')))) as line_no from decoded)"""
_INDENT = f"length(line) - length(regexp_replace(line, '^{_BLANK}+', ''))"
_STRIP = f"regexp_replace(line, '^{_BLANK}+|{_BLANK}+$', '', 'g')"
_CITED = """cited as (select lemma_id, coalesce(text, '') || chr(10) || 'zie N.N.B.W. ' || ['IV', 'ïv', 'lT', 'XI', 'IIII', 'X', 'II', 'VIII'][schutte_nr % 8 + 1] || ', ' || schutte_nr || '; Van der Aa XII, 1, ' || schutte_nr as s from lem)"""
_P_NNBW = r"N\.?\s*N\.?\s*B\.?\s*W\.?\s+([IVXivxïÏlT]+),\s*(\d+)"
_P_VDAA = r"Van der Aa\s+([IVXivxïÏlT]+),\s*(?:\d+,\s*)?(\d+)"
_P_LOOSE = r"(?i)N\.?\s*N\.?\s*B\.?\s*W\.?\s+([IVX]+),\s*(\d+)"
_P_WORK = r"(?i)(?:Aa|A\.?\s*a\.?),?\s*Biogr\.?\s*Woordenb\.?\s*(?:der\s*Nederlanden)?(?:,\s*(?:dl\.?\s*|d\.?\s*)?([\p{L}\p{N}_]+))?(?:,\s*(\d+))?"


def _linked(source: str, name: str, pattern: str, most: int, path: str, ampersand: str, loose: bool = False) -> tuple[str, str]:
    """Two tables of SQL: the matches of a citation in ``source``, and the text with a link for each that has a known volume and a page."""
    said = f"regexp_extract(m, '{pattern}', 1)"
    numeral = f"upper({said})" if loose else f"translate({said}, 'ïÏilTvx', 'IIIIIVX')"
    volume = f"nullif(list_position([{', '.join(repr(r) for r in T.ROMAN[:most])}], {numeral}), 0)::varchar"
    if loose:
        volume = f"coalesce({volume}, case when regexp_matches({said}, '^[0-9]+$') then regexp_replace({said}, '^0+([0-9])', '\\1') end)"
    page = f"regexp_extract(m, '{pattern}', 2)"
    link = f"case when {volume} is null or {page} = '' then m else '<a href=\"https://example.org/{path}/#source=' || {volume} || '{ampersand}page=' || {page} || '\">' || m || '</a>' end"
    return (
        f"{name}_m as (select lemma_id, string_split_regex(s, '{pattern}') as parts, list_transform(regexp_extract_all(s, '{pattern}'), lambda m: {link}) as links from {source})",
        f"{name} as (select lemma_id, array_to_string(list_transform(range(len(parts)), lambda k: parts[k + 1] || coalesce(links[k + 1], '')), '') as s from {name}_m)",
    )


_SURVEY = f"""surveyed as (select *, case when indent <> 0 then null when regexp_matches(bare, '^\\d+[a-z]?\\.\\s') then 'footnote' when regexp_matches(bare, '^\\d{{4}}') then 'period_header' when regexp_matches(bare, '^\\d+\\.\\s{{3,6}}[A-Z]') then 'lemma_entry' else 'other' end as pattern
  from (select corpus, page_nr, line_no, {_INDENT} as indent, regexp_replace(line, '^{_BLANK}+', '') as bare from plines where {_STRIP} <> '' and not regexp_matches({_STRIP}, '^\\d+$')))"""
_LAND = "regexp_replace(coalesce(toc_chapter, ''), '^[IVXLCDM]+\\.\\s*', '')"
_ROLE = """split as (select lemma_id, schutte_nr, beginjaar, unnest(string_split_regex(functie, '[,;]')) as part, unnest(range(len(string_split_regex(functie, '[,;]')))) as pos from lem where length(functie) <= 120),
roled as (select *, lower(role) as role_key from (select lemma_id, schutte_nr, beginjaar, pos, trim(regexp_replace(trim(regexp_replace(trim(part), '[ \\-.]+$', '')), '^\\s*(later|voorlopig)\\s+', '', 'i')) as role from split)
  where role <> '' and regexp_matches(role, '(agent|ambassadeur|envoy[eé]|resident|minister|commissaris|consul|secretaris|zaakgelastigde|gedeputeerde|gezant)', 'i'))"""
_TYPED = """tl0 as (select lemma_id, corpus, schutte_nr, unnest(string_split(text, chr(10))) as text, unnest(range(len(string_split(text, chr(10))))) as line_no from lem where text is not null),
tl1 as (select *, case when regexp_matches(text, '^\\d+\\s{5,}') then 'paginahoofd' when regexp_matches(text, '^\\d+\\.\\s{2,}') then case when try_cast(regexp_extract(text, '^(\\d+)', 1) as int) = schutte_nr then 'loopbaan' else 'noot' end
  when regexp_matches(text, '^(N\\.N?\\.B\\.W\\.|Van der Aa|Nagtglas|Elias|N\\.P\\.|N\\.A\\.|N\\.L\\.|Jb\\.|Wap\\.|Boreel|Engelbrecht|De Haan\\b|Dek,|Van Limburg Brouwer|Feenstra|Leemans|Sicco van Goslinga,)') then 'bronnen'
  when regexp_matches(text, '^(Zoon van|Dochter van)') then 'personalia' when regexp_matches(text, '^\\d{4}(-\\d{4})?\\s+\\w') then 'hoofd' end as fixed from tl0 where text <> ''),
typed as (select lemma_id, corpus, schutte_nr, line_no, text, coalesce(fixed, last_value(case when fixed = 'personalia' then fixed when fixed in ('bronnen', 'hoofd') then 'loopbaan' end ignore nulls) over (partition by lemma_id order by line_no rows between unbounded preceding and current row), 'loopbaan') as type from tl1)"""
_EDGES = """pgs as (select person_seq, corpus, unnest(pages) as page, unnest(range(len(pages))) as pos from idx),
edges as (select p.person_seq, p.corpus, e.schutte_nr, min(p.pos) as pos from pgs p join (select distinct corpus, schutte_nr, toc_page from lem where toc_page <> 0) e on p.corpus = e.corpus and p.page = e.toc_page group by all)"""
_LISTING = """ll as (select doc_id, unnest(string_split_regex(text, '\\r\\n|\\r|\\n')) as raw, unnest(range(len(string_split_regex(text, '\\r\\n|\\r|\\n')))) as line_no from documents where source = '{source}' and text is not null),
l as (select doc_id, line_no, regexp_replace(raw, '^{blank}+|{blank}+$', '', 'g') as t from ll),
k as (select *, {see} and not regexp_matches(regexp_extract(t, {pat}, 2, 'i'), '\\d') as see from l where t <> '' and not regexp_matches(t, '^(<\\?xml|INDEX|Alleen|waar zij|\\s*[A-Z]\\s*$)'))"""
_SEE = "'^(.+?),?\\s+zie(?:\\s+ook)?\\s+(.+)$'"
_PLACE_SEE = "'^(.+?),?\\s+zie\\s+(.+)$'"
_NR = "'^(.+?)\\s+\\((\\d+)\\)\\s+(.+)$'"
_NUMS = "'^([A-Za-zÀ-öø-ÿ.,\\s()*''\\-/]+?)\\s+(\\d[\\d\\s,/]*)$'"
_DIGITS = "array_to_string(list_filter(list_transform(regexp_extract_all({0}, '(\\d+)', 1), lambda x: try_cast(x as int)), lambda x: x is not null), ',')"
_STATUS = """st as (select t.corpus, t.schutte_nr, case when e.corpus is null then 'missing' when not e.has_text then 'unreadable' when e.toc_page <> t.page_nr then 'mismatch' else 'ok' end as status
  from (select * from toc1 where deleted_at is null) t left join (select corpus, schutte_nr, max(toc_page) as toc_page, bool_or(text is not null) as has_text from lem group by all) e on t.corpus = e.corpus and t.schutte_nr = e.schutte_nr)"""


_PLACE_LINES = _LISTING.format(source="geo_index", blank=_BLANK, see=f"regexp_matches(t, {_PLACE_SEE}, 'i')", pat=_PLACE_SEE) + f""",
placed as (select doc_id, line_no::int as line_no, kind, case kind when 'see' then trim(regexp_extract(t, {_PLACE_SEE}, 1, 'i')) else rtrim(trim(regexp_extract(t, {_NUMS}, 1)), ',') end as place, case when kind = 'mention' then {_DIGITS.format(f"regexp_extract(t, {_NUMS}, 2)")} else '' end as pages,
  case when kind = 'see' then trim(regexp_extract(t, {_PLACE_SEE}, 2, 'i')) end as see_also from (select *, case when see then 'see' when regexp_matches(t, {_NUMS}) then 'mention' end as kind from k) where kind is not null)"""
_NESTED = """pr as (select corpus, entry_nr as schutte_nr, arg_min(period_now, (page_nr, line_no)) as period from sessions where entry_nr is not null and period_now <> '' group by all),
ln as (select corpus, record_nr as schutte_nr, count(*) as n, md5(string_agg(concat_ws('|', record_zone, indent, text), chr(10) order by page_nr, line_no)) as lines_md5 from sessions where record_nr is not null and zone in ('lemma_entry', 'body', 'genealogy', 'sub_note') group by all),
nt0 as (select corpus, owner as schutte_nr, fn_nr, arg_max(fn_text, (page_nr, line_no)) as fn_text from (select *, coalesce(record_nr, first_value(entry_nr ignore nulls) over (partition by corpus, page_nr order by line_no rows between current row and unbounded following)) as owner from sessions)
  where zone = 'footnote' and fn_nr is not null and owner is not null group by all),
nt as (select corpus, schutte_nr, count(*) as n, md5(string_agg(concat_ws('|', fn_nr, fn_text), chr(10) order by fn_nr)) as notes_md5 from nt0 group by all)"""
_SYLLABLES = """(length(regexp_extract(regexp_extract({0}, '(\\S+)-$', 1), '\\p{{L}}+$')) >= 2 and regexp_matches(regexp_extract(regexp_extract({0}, '(\\S+)-$', 1), '\\p{{L}}+$'), '(?i)[""" + T._VOWEL + """]')
  and regexp_matches(regexp_extract({1}, '^\\s*(\\S+)', 1), '^\\p{{L}}{{2}}') and regexp_matches(regexp_extract({1}, '^\\s*(\\S+)', 1), '(?i)^""" + T._ONSET + "[" + T._VOWEL + """]'))"""


def _joined(left: str, right: str) -> str:
    return f"case when regexp_matches({right}, '^\\p{{Lu}}') or trim({right}) = '' then {left} || ' ' || {right} when {_SYLLABLES.format(left, right)} then substring({left}, 1, length({left}) - 1) || {right} else {left} || ' ' || {right} end"


def _with(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


SQL = {
    "page_lines": _with(_PAGES) + f"select corpus, page_nr, line_no::int as line_no, {_INDENT} as indent, md5(line) as line_md5 from plines",
    "page_text": _with(_PAGES) + f"""select corpus, page_nr, (count(*) filter (where s <> ''))::int as n_lines, md5(coalesce(string_agg(s, chr(10) order by k) filter (where s <> ''), '')) as text_md5 from (
        select corpus, page_nr, k, regexp_replace(l, '^{_BLANK}+|{_BLANK}+$', '', 'g') as s from (select corpus, page_nr, unnest(ls) as l, unnest(range(len(ls))) as k from (select corpus, page_nr, string_split(regexp_replace(regexp_replace(t, '<br\\s*/?>', chr(10), 'gi'), '<[^>]*>', '', 'g'), chr(10)) as ls from decoded))) group by all""",
    "decoded_pages": """with pg as (select distinct on (corpus, page_nr) corpus, page_nr, content from page_html where content is not null),
        cp as (select [8364, 65533, 8218, 402, 8222, 8230, 8224, 8225, 710, 8240, 352, 8249, 338, 65533, 381, 65533, 65533, 8216, 8217, 8220, 8221, 8226, 8211, 8212, 732, 8482, 353, 8250, 339, 65533, 382, 376] as high)
        select corpus, page_nr, md5(coalesce(try(decode(content)), array_to_string(list_transform(list_transform(regexp_extract_all(hex(content), '..'), lambda h: ('0x' || h)::int), lambda v: chr(case when v between 128 and 159 then high[v - 127] else v end)), ''))) as text_md5 from pg, cp""",
    "page_zones": _with(_PAGES, "printed as (select corpus, page_nr, line_no, line from plines)", _ZONED.split("from lem) where v is not null),\n")[1]) + "select corpus, zone, count(*) as n from zoned group by all",
    "line_zones": _with(_ZONED) + "select corpus, page_nr, line_no, indent, zone, fn_nr from zoned",
    "record_lines": _with(_SESSIONS) + "select corpus, record_nr as schutte_nr, page_nr, line_no, record_zone, md5(text) as text_md5 from sessions where record_nr is not null and zone in ('lemma_entry', 'body', 'genealogy', 'sub_note')",
    "record_periods": _with(_SESSIONS) + "select corpus, entry_nr as schutte_nr, arg_min(period_now, (page_nr, line_no)) as period from sessions where entry_nr is not null and period_now <> '' group by all",
    "record_notes": _with(_SESSIONS) + """select corpus, owner as schutte_nr, fn_nr, arg_max(fn_text, (page_nr, line_no)) as fn_text from (select *, coalesce(record_nr, first_value(entry_nr ignore nulls) over (partition by corpus, page_nr order by line_no rows between current row and unbounded following)) as owner from sessions)
        where zone = 'footnote' and fn_nr is not null and owner is not null group by all""",
    "records_nested": _with(_SESSIONS, _NESTED) + """select t.corpus, t.schutte_nr, t.title, pr.period, coalesce(ln.n, 0) as n_lines, ln.lines_md5, coalesce(nt.n, 0) as n_notes, nt.notes_md5
        from toc1 t left join pr on t.corpus = pr.corpus and t.schutte_nr = pr.schutte_nr left join ln on t.corpus = ln.corpus and t.schutte_nr = ln.schutte_nr left join nt on t.corpus = nt.corpus and t.schutte_nr = nt.schutte_nr""",
    "records_enriched": _with(_SESSIONS, _NESTED, _EDGES, """mentions as (select s.corpus, s.schutte_nr, string_agg(concat_ws(':', e.person_seq, e.pos, e.schutte_nr), ',' order by e.person_seq, e.pos, e.schutte_nr) as m from idx s join edges e on s.person_seq = e.person_seq and s.corpus = e.corpus
          where s.schutte_nr is not null and s.schutte_nr <> e.schutte_nr and exists (select 1 from lem where lem.corpus = s.corpus and lem.schutte_nr = s.schutte_nr) group by all),
        meta as (select corpus, schutte_nr, name, beginjaar, eindjaar from lem qualify row_number() over (partition by corpus, schutte_nr order by lemma_id desc) = 1)""")
    + """select t.corpus, t.schutte_nr, t.title, t.chapter, pr.period, me.name, me.beginjaar, me.eindjaar, coalesce(ln.n, 0) as n_lines, coalesce(nt.n, 0) as n_notes, md5(coalesce(mentions.m, '')) as mentions_md5
        from toc1 t left join pr on t.corpus = pr.corpus and t.schutte_nr = pr.schutte_nr left join ln on t.corpus = ln.corpus and t.schutte_nr = ln.schutte_nr left join nt on t.corpus = nt.corpus and t.schutte_nr = nt.schutte_nr
        left join meta me on t.corpus = me.corpus and t.schutte_nr = me.schutte_nr left join mentions on t.corpus = mentions.corpus and t.schutte_nr = mentions.schutte_nr""",
    "zone_carry": "select event_id, last_value(case when event_type <> 'view' then event_type end ignore nulls) over (partition by user_id order by ts, event_id rows between unbounded preceding and current row) as state from events",
    "lookahead_reclass": "select event_id, case when event_type = 'click' and nxt >= 10 then 'entry' else event_type end as kind from (select *, first_value(case when event_type <> 'view' then value end ignore nulls) over (partition by user_id order by ts, event_id rows between 1 following and unbounded following) as nxt from events)",
    "carry_two_level": "select event_id, last_value(case when event_type = 'signup' then event_id end ignore nulls) over (order by ts, event_id rows between unbounded preceding and current row) as record_id from events",
    "islands": """select user_id, block, min(event_type) as event_type, count(*) as n, min(event_id) as first_event from (select *, sum(turn) over (partition by user_id order by ts, event_id rows between unbounded preceding and current row)::int as block from (
        select *, case when p is null or p <> event_type or event_type = 'error' or p = 'error' then 1 else 0 end as turn from (select *, lag(event_type) over (partition by user_id order by ts, event_id) as p from events))) group by all""",
    "trim_trailing": _with(_ONCE) + "select lemma_id, count(*) as n, max(seq) as last_seq from (select *, max(case when zone <> 'sub_note' then seq end) over (partition by lemma_id) as keep from (select lemma_id, l.zone as zone, l.seq as seq from (select lemma_id, unnest(lines) as l from lem))) where seq <= keep group by all",
    "line_types": _with(_ONCE, _TYPED) + "select lemma_id, line_no::int as line_no, type, md5(text) as text_md5 from typed",
    "prev_next": _with(_ONCE) + "select corpus, schutte_nr, lag(schutte_nr) over (partition by corpus order by schutte_nr) as prev_nr, lead(schutte_nr) over (partition by corpus order by schutte_nr) as next_nr from (select distinct corpus, schutte_nr from lem)",
    "toc_join": _with(_ONCE) + "select t.corpus, t.schutte_nr, t.title, coalesce(e.n, 0) as n_lines from toc1 t left join (select corpus, schutte_nr, max(coalesce(len(lines), 0)) as n from lem group by all) e on t.corpus = e.corpus and t.schutte_nr = e.schutte_nr",
    "overlay": _with(_ONCE) + "select t.corpus, t.schutte_nr, case when coalesce(e.a, '') <> '' then e.a else t.title end as title, case when coalesce(e.b, '') <> '' then e.b else t.chapter end as chapter from toc1 t left join (select corpus, schutte_nr, max(toc_title) as a, max(toc_chapter) as b from lem group by all) e on t.corpus = e.corpus and t.schutte_nr = e.schutte_nr",
    "meta_last_wins": "select o_custkey, o_orderkey, o_orderstatus from orders qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1",
    "year_precedence": _with(_ONCE) + "select lemma_id, coalesce(try_cast(regexp_extract(period, '^(\\d{4})', 1) as int), nullif(beginjaar, 0)) as period_first, coalesce(nullif(beginjaar, 0), try_cast(regexp_extract(period, '^(\\d{4})', 1) as int)) as year_first from lem",
    "page_refs": _with(_ONCE, _EDGES) + "select person_seq, corpus, schutte_nr, pos::int as pos from edges",
    "mentioned_in": _with(_ONCE, _EDGES) + "select s.corpus, s.schutte_nr as subject, e.schutte_nr, e.person_seq, e.pos::int as pos from idx s join edges e on s.person_seq = e.person_seq and s.corpus = e.corpus where s.schutte_nr is not null and s.schutte_nr <> e.schutte_nr and exists (select 1 from lem where lem.corpus = s.corpus and lem.schutte_nr = s.schutte_nr)",
    "ordered_distinct": _with(_ONCE) + "select person_seq, page, min(pos)::int as pos from (select person_seq, unnest(pages) as page, unnest(range(len(pages))) as pos from idx) where page is not null group by all",
    "person_lines": _with(_LISTING.format(source="person_index", blank=_BLANK, see=f"regexp_matches(t, {_SEE}, 'i')", pat=_SEE))
    + f"""select doc_id, line_no::int as line_no, kind, trim(case kind when 'see' then regexp_extract(t, {_SEE}, 1, 'i') when 'entry' then regexp_extract(t, {_NR}, 1) when 'mention' then rtrim(trim(regexp_extract(t, {_NUMS}, 1)), ',') else t end) as name,
        case when kind = 'entry' then try_cast(regexp_extract(t, {_NR}, 2) as int) end as nr, case kind when 'entry' then {_DIGITS.format(f"regexp_extract(t, {_NR}, 3)")} when 'mention' then {_DIGITS.format(f"regexp_extract(t, {_NUMS}, 2)")} else '' end as pages,
        case when kind = 'see' then trim(regexp_extract(t, {_SEE}, 2, 'i')) end as see_also from (select *, case when see then 'see' when regexp_matches(t, {_NR}) then 'entry' when regexp_matches(t, {_NUMS}) then 'mention' when regexp_matches(t, '[A-Za-z]') then 'bare' end as kind from k) where kind is not null""",
    "place_lines": _with(_PLACE_LINES) + "select * from placed",
    "role_index": _with(_ONCE, _ROLE) + """select role_key, sum(n)::bigint as n, arg_min(role, (-n, f, role)) as role, min(f[1])::int as first_year
        from (select role_key, role, count(*) as n, min((coalesce(nullif(beginjaar, 0), 9999), schutte_nr, lemma_id, pos)) as f from roled group by all) group by role_key""",
    "role_persons": _with(_ONCE, _ROLE) + """select role_key, row_number() over (partition by role_key order by coalesce(nullif(r.beginjaar, 0), 9999), r.schutte_nr, lemma_id, pos)::int as place, role, corpus, r.schutte_nr,
        concat_ws(' ', nullif(trim(givenname), ''), nullif(trim(intraposition), ''), nullif(trim(name), '')) as name, nullif(r.beginjaar, 0) as begin, nullif(eindjaar, 0) as "end", coalesce(category, '') as category from roled r join lem using (lemma_id)""",
    "chapters": _with(_ONCE, """meta as (select corpus, schutte_nr, nullif(beginjaar, 0) as begin, nullif(eindjaar, 0) as e, case when length(coalesce(functie, '')) <= 120 then substring(coalesce(functie, ''), 1, 80) else '' end as functie from lem qualify row_number() over (partition by corpus, schutte_nr order by lemma_id desc) = 1)""")
    + """select t.corpus, t.chapter, coalesce(nullif(regexp_replace(regexp_replace(lower(regexp_replace(t.chapter, '^[IVXLCDM]+\\.\\s*', '', 'i')), '[^\\p{L}\\p{N}_]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'onbekend') as slug,
        row_number() over (partition by t.corpus, t.chapter order by coalesce(m.begin, 9999), t.schutte_nr)::int as place, t.schutte_nr, coalesce(t.full_title, '') as title, m.begin, m.e as "end", coalesce(m.functie, '') as functie
        from toc1 t left join meta m on t.corpus = m.corpus and t.schutte_nr = m.schutte_nr where t.chapter is not null and t.schutte_nr <> 0""",
    "persons_sorted": _with(_ONCE) + "select name, person_seq, corpus, schutte_nr from idx order by name, person_seq",
    "places_sorted": _with(_PLACE_LINES) + "select place, doc_id, line_no, pages from placed order by place, doc_id, line_no",
    "search_index": _with(_ONCE) + "select corpus, schutte_nr, coalesce(toc_title, '') as title, coalesce(toc_chapter, '') as land, nullif(beginjaar, 0) as begin, nullif(eindjaar, 0) as \"end\", case when length(coalesce(functie, '')) <= 120 then substring(coalesce(functie, ''), 1, 100) else '' end as functie from lem",
    "timeline": _with(_ONCE) + "select corpus, schutte_nr, coalesce(nullif(trim(toc_title), ''), nullif(trim(name), ''), 'Nr. ' || schutte_nr) as name, beginjaar as start, nullif(eindjaar, 0) as \"end\", coalesce(category, '') as category, coalesce(functie, '') as functie from lem where beginjaar <> 0",
    "decade_grid": _with(_ONCE) + f"select corpus, {_LAND} as land, (beginjaar // 10 * 10)::int as decade, count(*) as n from lem where beginjaar > 0 group by all",
    "corpus_counts": _with(_ONCE, _PLACE_LINES) + "select corpus, count(*) as n, 'entries' as what from lem group by all union all select corpus, count(*), 'persons' from idx group by all union all select corpus, count(*), 'pages' from (select distinct corpus, page_nr from page_html) group by all union all select corpus, count(*), 'places' from placed join documents using (doc_id) group by all",
    "indent_histogram": _with(_PAGES) + f"select corpus, {_INDENT} as indent, count(*) as n from plines group by all",
    "page_tails": _with(_PAGES) + f"select corpus, page_nr, row_number() over (partition by corpus, page_nr order by line_no desc)::int as from_end, line_no::int as line_no from plines where {_STRIP} <> '' qualify from_end <= 8",
    "first_by_year": _with(_ONCE) + "select corpus, schutte_nr, coalesce(nullif(beginjaar, 0), 9999) as year from lem order by year, schutte_nr, corpus limit 20",
    "verify_status": _with(_ONCE, _STATUS) + "select corpus, schutte_nr, status from st",
    "verify_report": _with(_ONCE, _STATUS) + "select corpus, status, count(*) as n, min(schutte_nr) as first_nr from st group by all",
    "title_lookup": _with(_ONCE) + "select lemma_id, coalesce(nullif(trim(t.title), ''), nullif(trim(name), ''), 'Nr. ' || lem.schutte_nr) as title from lem left join toc1 t on lem.corpus = t.corpus and lem.schutte_nr = t.schutte_nr",
    "assembled_names": _with(_ONCE) + "select lemma_id, concat_ws(' ', nullif(trim(givenname), ''), nullif(trim(intraposition), ''), nullif(trim(name), '')) as full_name, lpad(schutte_nr::varchar, greatest(4, length(schutte_nr::varchar))::int, '0') as nr from lem",
    "roman_links": _with(_ONCE, _CITED, "s0 as (select lemma_id, s from cited)", *_linked("s0", "s1", _P_NNBW, 10, "nnbw", "&amp;"), *_linked("s1", "s2", _P_VDAA, 21, "vdaa", "&amp;")) + "select lemma_id, md5(s) as linked_md5 from s2",
    "loose_links": _with(_ONCE, _CITED, "s0 as (select lemma_id, s || '; van der Aa, Biogr. Woordenb. der Nederlanden, dl. 007, 12 en A.a., biogr woordenb., IX, 3; Aa, Biogr. Woordenb.; nnbw iv, 9' as s from cited)", *_linked("s0", "s1", _P_LOOSE, 10, "nnbw", "&", True), *_linked("s1", "s2", _P_WORK, 10, "vdaa", "&", True))
    + "select lemma_id, md5(s) as linked_md5 from s2",
    "inline_notes": _with(_ONCE) + """, m as (select lemma_id, regexp_replace(regexp_replace(text || ' rapport' || schutte_nr || 'a en brief12a3, x10000b en (zie)7', '([A-Za-z)])(\\d+)', '\\1⟦\\2⟧', 'g'), '⟧([a-z])([^0-9⟦]|$)', '\\1⟧\\2', 'g') as s from lem where text is not null)
        select lemma_id, array_to_string(list_filter(regexp_extract_all(s, '⟦([^⟧]*)⟧', 1), lambda k: not regexp_matches(k, '^\\d{4,}')), ',') as notes from m""",
    "page_hyphens": _with(_ONCE) + f"select lemma_id, seq, {_joined('text', 'nxt')} as joined from (select *, lead(text) over (partition by lemma_id order by seq) as nxt from (select lemma_id, l.seq as seq, l.text as text from (select lemma_id, unnest(lines) as l from lem)) where text is not null) where text like '%-' and length(text) > 1 and nxt is not null",
    "display_blocks": "with recursive " + _ONCE + f""",
        ls as (select lemma_id, l.zone as zone, l.text as text, l.seq as seq from (select lemma_id, unnest(lines) as l from lem) where l.text is not null),
        turned as (select *, case when lag(1) over w is null or zone is distinct from lag(zone) over w then 1 else 0 end as turn from ls window w as (partition by lemma_id order by seq)),
        blocked as (select *, sum(turn) over (partition by lemma_id order by seq rows between unbounded preceding and current row)::int as block from turned),
        placed as (select *, row_number() over (partition by lemma_id, block order by seq, text) as k from blocked),
        folded as (select lemma_id, block, k, text from placed where k = 1
          union all select p.lemma_id, p.block, p.k, case when f.text like '%-' then {_joined('f.text', 'p.text')} else f.text || ' ' || p.text end from folded f join placed p on f.lemma_id = p.lemma_id and f.block = p.block and p.k = f.k + 1)
        select f.lemma_id, f.block, any_value(zone) as zone, count(distinct p.k) as n_lines, arg_max(f.text, f.k) as text from folded f join placed p on f.lemma_id = p.lemma_id and f.block = p.block group by f.lemma_id, f.block""",
    "entry_xml": _with(_ONCE, _TYPED, """esc as (select corpus, schutte_nr, line_no, '<line type="' || type || '">' || replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</line>' as x from typed),
        bodies as (select corpus, schutte_nr, string_agg(x, chr(10) order by line_no, x) as body from esc group by all),
        meta as (select corpus, schutte_nr, [['schuttenr', schutte_nr::varchar], ['corpus', corpus], ['name', name], ['givenname', givenname], ['begin', beginjaar::varchar], ['eind', eindjaar::varchar], ['functie', functie]] as a from lem qualify row_number() over (partition by corpus, schutte_nr order by lemma_id desc) = 1)""")
    + """select b.corpus, b.schutte_nr, md5('<lemma ' || array_to_string(list_transform(list_filter(a, lambda p: coalesce(trim(p[2]), '') <> ''), lambda p: p[1] || '="' || replace(replace(replace(replace(p[2], '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') || '"'), ' ') || '>' || chr(10) || body || chr(10) || '</lemma>') as xml_md5
        from bodies b join meta m on b.corpus = m.corpus and b.schutte_nr = m.schutte_nr""",
    "entry_xml_lines": _with(_ONCE, _TYPED) + "select corpus, schutte_nr, case type when 'loopbaan' then 'body' when 'personalia' then 'genealogy' when 'bronnen' then 'bronnen' when 'hoofd' then 'period_header' when 'noot' then 'footnote' end as zone, count(*) as n from typed where type <> 'paginahoofd' group by all",
    "corpus_pages": _with(_PRINTED) + f"""select corpus, page_nr, md5('<page number="' || page_nr || '">' || string_agg(replace(replace(replace(s, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '<br>' order by line_no, s) || '</page>') as xml_md5 from (select corpus, page_nr, line_no, {_STRIP} as s from printed) group by corpus, page_nr""",
    "tagged_starts": _with(_ONCE) + """, li as (select base + l.seq as seq, l.text as text from (select lemma_id * 1000 as base, unnest(lines) as l from lem) where l.text is not null),
        st as (select lemma_id, regexp_replace(substring(lines[1].text, 5, 24), '^[\\s\\x{00A0}\\x{2000}-\\x{200A}\\x{202F}]+|[\\s\\x{00A0}\\x{2000}-\\x{200A}\\x{202F}]+$', '', 'g') as start from lem),
        met as (select lemma_id, start, min(seq) as seq from st join li on contains(text, start) where start <> '' group by all),
        one as (select seq, arg_min(start, lemma_id) as start, min(lemma_id) as nr from met group by seq)
        select seq, substring(text, 1, instr(text, start) - 1) || '<start schuttenr="' || nr || '">' || start || '</start>' || substring(text, instr(text, start) + length(start)) as text from li join one using (seq)""",
    "survey_patterns": _with(_PAGES, _SURVEY) + "select corpus, pattern, count(*) as n, count(distinct page_nr) as n_pages from surveyed where pattern is not null group by all",
    "survey_pages": _with(_PAGES, _SURVEY) + "select corpus, count(*) filter (where has) as with_notes, count(*) filter (where not has) as without_notes from (select d.corpus, d.page_nr, exists (select 1 from surveyed s where s.corpus = d.corpus and s.page_nr = d.page_nr and pattern = 'footnote') as has from decoded d) group by all",
    "survey_anomalies": _with(_PAGES, _SURVEY) + "select corpus, page_nr, line_no::int as line_no, substring(bare, 1, 50) as begins from surveyed where pattern = 'other'",
    "note_contexts": _with(_ONCE) + """, c as (select lemma_id, string_split_regex(text, '[\\p{L}\\p{N}_]\\d+[a-z]?\\s*[;,.\\s]') as parts, regexp_extract_all(text, '[\\p{L}\\p{N}_]\\d+[a-z]?\\s*[;,.\\s]') as marks from lem where text is not null),
        e as (select lemma_id, unnest(marks) as mark, unnest(range(len(marks))) as pos, unnest(list_transform(range(len(marks)), lambda k: (list_sum(list_transform(parts[1:k + 1], lambda x: length(x))) + coalesce(list_sum(list_transform(marks[1:k], lambda x: length(x))), 0))::int)) as begun from c)
        select lemma_id, pos::int as pos, mark, substring(text, greatest(begun - 5, 0) + 1, begun + length(mark) + 5 - greatest(begun - 5, 0)) as context from e join lem using (lemma_id)""",
    "paired_pages": """with p as (select distinct corpus, page_nr from page_html), n as (select corpus, page_nr, row_number() over (partition by corpus order by page_nr) as k from p)
        select a.k::int as k, a.page_nr as nl, b.page_nr as bl from n a join n b on a.k = b.k where a.corpus = 'nl' and b.corpus = 'bl'""",
    "number_links": _with(_ONCE) + """, t as (select lemma_id, corpus, replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&#34;'), chr(39), '&#39;') || ' (zie sub nr.  ' || schutte_nr || '), nr.' || lemma_id as s from lem where text is not null),
        c as (select lemma_id, corpus, string_split_regex(s, '(?:zie sub\\s+)?nr\\.\\s*\\d+') as parts, regexp_extract_all(s, '(?:zie sub\\s+)?nr\\.\\s*\\d+') as found from t),
        made as (select lemma_id, parts, list_transform(found, lambda m: case when starts_with(m, 'zie sub') then 'zie sub ' else '' end || '<a href="' || corpus || '/' || lpad(regexp_extract(m, '(\\d+)$', 1)::int::varchar, greatest(4, length(regexp_extract(m, '(\\d+)$', 1)::int::varchar))::int, '0')
          || '/index.html" title="Ga naar lemma ' || regexp_extract(m, '(\\d+)$', 1)::int || '">nr.' || chr(160) || regexp_extract(m, '(\\d+)$', 1)::int || '</a>') as links from c)
        select lemma_id, md5(array_to_string(list_transform(range(len(parts)), lambda k: parts[k + 1] || coalesce(links[k + 1], '')), '')) as html_md5 from made""",
    "start_locations": _with(_ONCE) + """, li as (select base + l.seq as seq, regexp_replace(trim(l.text), '\\s+', ' ', 'g') as f from (select lemma_id * 1000 as base, unnest(lines) as l from lem) where l.text is not null)
        select s.lemma_id, m.seq from (select lemma_id, regexp_replace(trim(lines[1].text), '\\s+', ' ', 'g') as f from lem where trim(lines[1].text) <> '') s left join (select f, min(seq) as seq from li group by f) m on s.f = m.f""",
    "start_fragments": _with(_ONCE) + """, li as (select base + l.seq as seq, l.text as text from (select lemma_id * 1000 as base, unnest(lines) as l from lem) where l.text is not null),
        places as (select seq, sum(length(text) + 1) over (order by seq) - length(text) as place from li), doc as (select string_agg(text || chr(10), '' order by seq) as doc from li),
        st as (select lemma_id, regexp_replace(case when lemma_id % 2 = 0 then substring(lines[1].text, 11, 1000) || chr(10) || substring(lines[2].text, 1, 8) else substring(lines[1].text, 5, 24) end, '^[\\s\\x{00A0}\\x{2000}-\\x{200A}\\x{202F}]+|[\\s\\x{00A0}\\x{2000}-\\x{200A}\\x{202F}]+$', '', 'g') as start from lem),
        found as (select lemma_id, nullif(instr(doc, start), 0) as at from st, doc where start <> '')
        select lemma_id, seq from found asof left join places on found.at >= places.place""",
    "segments": _with(_ONCE) + f"""select corpus, schutte_nr, count(*) as n_lines, md5(string_agg(t, chr(10) order by k)) as lines_md5 from (select corpus, schutte_nr, k, regexp_replace(regexp_replace(l, '<[^>]*>', '', 'g'), '^{_BLANK}+|{_BLANK}+$', '', 'g') as t
        from (select corpus, schutte_nr, unnest(ls) as l, unnest(range(len(ls))) as k from (select corpus, schutte_nr, string_split('x' || arg_max(text, lemma_id), chr(10)) as ls from lem where text is not null group by corpus, schutte_nr))) where t <> '' group by all""",
    "ocr_lines": _with(_ONCE) + f"""select a.lemma_id, html_lines, hocr_lines, low_conf from
        (select lemma_id, (count(*) filter (where t <> ''))::int as html_lines from (select lemma_id, regexp_replace(regexp_replace(l, '<[^>]*>', '', 'g'), '^{_BLANK}+|{_BLANK}+$', '', 'g') as t from (select lemma_id, unnest(string_split(regexp_replace(text, '<br\\s*/?>', chr(10), 'gi'), chr(10))) as l from lem where text is not null)) group by all) a
        join (select lemma_id, count(*)::int as hocr_lines, sum(len(list_filter(ws, lambda s: 60 + (length(s) * 7) % 40 < 80)))::bigint as low_conf from (select lemma_id, r.indent as indent, list_filter(string_split(coalesce(r.text, ''), ' '), lambda s: s <> '') as ws from (select lemma_id, unnest(lines) as r from lem)) where 100 + indent * 50 <= 600 and len(ws) > 0 group by all) b using (lemma_id)""",
    "hocr_lines": _with(_ONCE) + """, h as (select lemma_id, unnest(list_sort(list_transform(lines, lambda r: {'seq': r.seq, 'text': coalesce(r.text, ''), 'indent': r.indent}))) as r, unnest(range(len(lines))) as line_no from lem where len(lines) > 0),
        w as (select lemma_id, line_no, 100 + r.indent * 50 as x, list_filter(string_split(r.text, ' '), lambda s: s <> '') as ws from h),
        k as (select * from w where x <= 600 and len(ws) > 0),
        m as (select lemma_id, list_sort(list(x)) as xs from k group by lemma_id)
        select k.lemma_id, line_no::int as line_no, x, case when x - mg < 30 then 0 when x - mg < 130 then 5 else 10 end as indent, array_to_string(ws, ' ') as text, len(list_filter(ws, lambda s: 60 + (length(s) * 7) % 40 < 80)) as low
        from k join (select lemma_id, xs[greatest(floor(len(xs) * 0.05)::int - 1, 0) + 1] as mg from m) g on k.lemma_id = g.lemma_id""",
    "streamed_pages": "select corpus, count(*) as n, max(page_nr) as last_page from page_html group by all",
    "metadata_rows": _with(_ONCE) + "select corpus, schutte_nr, coalesce(nullif(trim(name), ''), '') as name, coalesce(nullif(trim(givenname), ''), '') as givenname, nullif(beginjaar, 0) as beginjaar, nullif(eindjaar, 0) as eindjaar, coalesce(nullif(trim(functie), ''), '') as functie, coalesce(nullif(trim(category), ''), '') as category from lem qualify row_number() over (partition by corpus, schutte_nr order by lemma_id desc) = 1",
    "new_pages": _with(_ONCE) + "select corpus, corpus || '/' || lpad(page::varchar, greatest(4, length(page::varchar))::int, '0') as file from (select distinct corpus, unnest(pages) as page from idx) w where page is not null and not exists (select 1 from page_html p where p.corpus = w.corpus and p.page_nr = w.page)",
}
