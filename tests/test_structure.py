"""Literal rule cases, and the window forms of sequential operators against small serial models."""

import bisect
import random

import pytest
from pyspark.sql import functions as F

from colophon.functions import text as T
from colophon.operators import carry, features, joins, records, refs, roles, rules
from colophon.sources import pages, sinks
from colophon.streaming import ingest


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", expr(F.col("v")).alias("x")).orderBy("i").collect()]


MARGIN = [
    ("", "blank", "blank"), ("42", "page_number", "page_number"), ("11.   Res. 14 maart.", "footnote", "footnote"), ("11a.  See there.", "footnote", "footnote"), ("1598-1613 agent", "period_header", "period_header"), ("1637 secretaris", "period_header", "period_header"),
    ("123456 x", "period_header", "period_header"), ("1598.  text", "footnote", "footnote"), ("11 Res. fol. 3", "chapter_intro", "footnote"), ("12 NORTHLAND", "chapter_intro", "footnote"), ("7. Anna Berg", "lemma_entry", "lemma_entry"), ("7. (Anna) Berg", "lemma_entry", "lemma_entry"),
    ("7.   Anna Berg", "footnote", "footnote"), ("7. Élise Berg", "chapter_intro", "chapter_intro"), ("7.Anna", "chapter_intro", "chapter_intro"), ("Northland chapter", "chapter_intro", "chapter_intro"),
]


def test_margin_rules(spark):
    for corpus, k in (("nl", 1), ("bl", 2)):
        assert column(spark, [m[0] for m in MARGIN], lambda c: rules.margin_zone(c, F.lit(corpus))) == [m[k] for m in MARGIN]


def test_bands_and_lookahead(spark):
    lines = [" a", "     b", "      c", "        d", "         e", "            f", "             g", "             12", "", "             h", "\xa0\xa0x", "\ny", "7.   Anna", "", "     next", "8.  Note", "z"]
    df = spark.createDataFrame([("nl", 1, i, t) for i, t in enumerate(lines)], "corpus string, page int, line_no int, line string")
    got = [(r.indent, r.zone) for r in rules.classify_lines(df, ["corpus", "page"], ["line_no"]).orderBy("line_no").collect()]
    assert got == [(1, "body"), (5, "body"), (6, "genealogy"), (8, "genealogy"), (9, "sub_note"), (12, "sub_note"), (13, "sub_note"), (13, "page_number"), (0, "blank"), (13, "sub_note"), (2, "body"), (1, "body"), (0, "lemma_entry"), (0, "blank"), (5, "body"), (0, "footnote"), (0, "chapter_intro")]


PERSONS = [
    ("Berg, Anna (165) 199", ("entry", "Berg, Anna", 165, [199], None)), ("Berg, Anna 396, 414", ("mention", "Berg, Anna", None, [396, 414], None)), ("Berg, zie Van Berg", ("see", "Berg", None, [], "Van Berg")), ("Berg zie ook Dal", ("see", "Berg", None, [], "Dal")),
    ("Berg, zie ook Dal 12", ("mention", "Berg, zie ook Dal", None, [12], None)), ("Berg, A. (5) 622/623, 9", ("entry", "Berg, A.", 5, [622, 623, 9], None)), ("Berg, A. (5) (1735-1826) 12", ("entry", "Berg, A.", 5, [1735, 1826, 12], None)), ("Berg, A. (5)", ("bare", "Berg, A. (5)", None, [], None)),
    ("Š Berg 4", ("bare", "Š Berg 4", None, [], None)), ("A", None), ("INDEX OF X", None), ("123", None), ("", None),
]
PLACES = [("Aken (Aachen) 257", ("mention", "Aken (Aachen)", [257], None)), ("Bern 62, 64/65", ("mention", "Bern", [62, 64, 65], None)), ("Bern zie ook Thun", ("see", "Bern", [], "ook Thun")), ("Ål 5", ("mention", "Ål", [5], None)), ("Bern", None), ("Łódź 5", None)]


def test_index_lines(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(PERSONS)], "i int, line string")
    got = {r.i: (r.kind, r["name"], r.nr, list(r.pages), r.see_also) for r in rules.parse_person_lines(df).collect()}
    assert got == {i: w for i, (_, w) in enumerate(PERSONS) if w}
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(PLACES)], "i int, line string")
    assert {r.i: (r.kind, r.place, list(r.pages), r.see_also) for r in rules.parse_place_lines(df).collect()} == {i: w for i, (_, w) in enumerate(PLACES) if w}


def test_line_types_and_trimming(spark):
    lines = ["5.   Anna Berg", "werd agent", "12      NORTHLAND", "Dochter van X", "en Y", "3.  Res. fol. 2", "geboren te Z", "N.N.B.W. IV, 3", "vervolg", "Zoon van Q", "1605-1607 agent", "tekst", "1610 resident"]
    df = spark.createDataFrame([(5, i, t) for i, t in enumerate(lines)], "schutte_nr int, seq int, text string")
    typed = rules.type_lines(df, ["schutte_nr"], "seq")
    assert [r.type for r in typed.orderBy("seq").collect()] == ["loopbaan", "loopbaan", "paginahoofd", "personalia", "personalia", "noot", "personalia", "bronnen", "loopbaan", "personalia", "hoofd", "loopbaan", "hoofd"]
    assert carry.trim_trailing(typed, F.col("type") == "hoofd", ["schutte_nr"], "seq").count() == 12


def test_citations(spark):
    t = lambda vol, page, what, path="nnbw": f'<a href="https://example.org/{path}/#source={vol}&amp;page={page}">{what}</a>'
    cases = {
        "N.N.B.W. IV, 392": t(4, 392, "N.N.B.W. IV, 392"), "NNBW ïv, 5": t(4, 5, "NNBW ïv, 5"), "N.N.B.W. lT, 7": t(2, 7, "N.N.B.W. lT, 7"), "N.N.B.W. XI, 3": "N.N.B.W. XI, 3", "N.N.B.W. IIII, 3": "N.N.B.W. IIII, 3", "Van der Aa I, 24": t(1, 24, "Van der Aa I, 24", "vdaa"),
        "zie Van der Aa XII, 1, 363 en N.N.B.W. II, 1.": f'zie {t(12, 363, "Van der Aa XII, 1, 363", "vdaa")} en {t(2, 1, "N.N.B.W. II, 1")}.', "van der Aa I, 24": "van der Aa I, 24", "": "",
    }
    assert column(spark, list(cases), T.link_citations) == list(cases.values())


def test_roles(spark):
    df = spark.createDataFrame([(1, "zonder rang, ambassadeur 1592, gedeputeerde 1607"), (2, "Agent (tijdelijk) 1600.; agent 1601"), (3, "later minster resident?"), (4, "extraordinairs ambas- sadeur"), (5, "secretaries"), (6, "agent" + "x" * 130), (7, None)], "lemma_id int, functie string")
    got = sorted((r.lemma_id, r.pos, r.role) for r in roles.roles(df).collect())
    assert got == [(1, 1, "ambassadeur"), (1, 2, "gedeputeerde"), (2, 0, "Agent"), (2, 1, "agent"), (3, 0, "minister resident"), (4, 0, "extraordinaris ambassadeur")]
    rows = spark.createDataFrame([(1, 2, 1600, "agent"), (2, 3, 0, "Agent"), (3, 1, 1600, "Agent"), (4, 9, None, "agent")], "lemma_id int, schutte_nr int, beginjaar int, functie string")
    assert [tuple(r) for r in roles.role_index(roles.roles(rows)).collect()] == [("agent", 4, "Agent", 1600)]


def test_scalars(spark):
    assert column(spark, ["1598", "1598.0", "", None, "ca. 1600", "1598.9", "-1.5"], T.whole_number) == [1598, 1598, None, None, None, 1598, -1]
    assert column(spark, ["IV. Het Noorden & Zuid", "--", "", "Über"], T.slug) == ["het-noorden-zuid", "onbekend", "onbekend", "über"]
    assert column(spark, ["a" * 130, "b" * 120, "c"], lambda c: T.guarded(c, 80)) == ["", "b" * 80, "c"]
    assert column(spark, [" a ", "", None], lambda c: T.fallback(c, F.lit("z"))) == ["a", "z", "z"]
    assert column(spark, ["x<br>\n <b>y</b><BR/> z &amp;<br>", ""], T.html_text) == ["x\ny\nz &amp;", ""]
    assert column(spark, [bytearray(b"caf\xc3\xa9"), bytearray(b"caf\xe9"), None], T.decode_bytes, "binary") == ["café", "café", None]
    thrice = "ü".encode().decode("latin-1").encode().decode("latin-1").encode().decode("cp1252")
    assert column(spark, ["JÃ©rÃ´me", "plain", thrice + "�x", None], T.repair_rounds) == ["Jérôme", "plain", "ü?x", None]
    assert column(spark, ["uit12 en 15933a x1598 rapport7b)3"], T.inline_notes) == [["12", "7b", "3"]]


def test_markup_and_xml(spark):
    df = spark.createDataFrame([("nl", 'zie sub nr. 12, "a" agent1 en graaf11.', ["1", "11"])], "corpus string, t string, k array<string>")
    got = df.select(T.inline_markup(F.col("t"), F.col("corpus"), F.col("k")).alias("x")).first().x
    note = lambda k: f'<sup><a href="#fn-{k}" id="ref-{k}">{k}</a></sup>'
    assert got == f'zie sub <a href="nl/0012/index.html" title="Ga naar lemma 12">nr.\xa012</a>, &#34;a&#34; agent{note("1")} en graaf{note("11")}.'
    # keys are plain text
    odd = spark.createDataFrame([("nl", "agent*$1 en graaf+ en x(2", ["*$1", "+", "(2", "a\\\\E"])], "corpus string, t string, k array<string>")
    assert odd.select(T.inline_markup(F.col("t"), F.col("corpus"), F.col("k")).alias("x")).first().x == f"agent{note('*$1')} en graaf{note('+')} en x{note('(2')}"
    import xml.etree.ElementTree as ET

    lines = spark.createDataFrame([("nl", 3, 1, 'een "<b>" & N.N.B.W. IV, 2', "bronnen"), ("nl", 3, 2, "x", "noot")], "corpus string, schutte_nr int, seq int, text string, type string")
    meta = spark.createDataFrame([("nl", 3, 'van "X" & Y', None, 1600, None, "")], "corpus string, schutte_nr int, name string, givenname string, beginjaar int, eindjaar int, functie string")
    root = ET.fromstring(sinks.lemma_xml(lines, meta, "seq").first().xml)
    assert root.attrib == {"schuttenr": "3", "corpus": "nl", "name": 'van "X" & Y', "begin": "1600"} and len(root) == 2


def test_hyphens(spark):
    cases = [("opge-", "volgd", "opgevolgd"), ("Jan-", "Pieter", "Jan- Pieter"), ("-", "x", "- x"), ("de commis-", "saris ging", "de commissaris ging"), ("ambas-", "sadeur", "ambassadeur"), ("pen-", "sio", "pensio"), ("Ka-", "tho", "Katho"), ("Poi-", "tou", "Poitou"), ("Groene-", "velt", "Groenevelt"), ("ver-", "t", "ver- t"), ("conf-", "lict", "conflict"), ("st-", "aten", "st- aten"), ("verd-", "rtien", "verd- rtien"), ("een-", "", "een- "), ("één-", "Één", "één- Één")]
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(cases)], "i int, a string, b string")
    assert [r.x for r in df.select("i", T.join_hyphen(F.col("a"), F.col("b")).alias("x")).orderBy("i").collect()] == [c[2] for c in cases]
    assert df.where("i = 9").select(T.join_hyphen(F.col("a"), F.col("b"), F.lit(True)).alias("x")).first().x == "vert"


def test_declared_encodings(spark):
    cases = [(b'<?xml version="1.0" encoding="cp1250"?>\xe8', '<?xml version="1.0" encoding="cp1250"?>č'), ("één".encode(), "één"), (b"caf\xe9 \x80\x81", "café €\ufffd"), (b"encoding='nonsense' \xe9", "encoding='nonsense' é"), (b"", ""), (None, None), (b" " * 300 + b"encoding='cp1250'\xe8", " " * 300 + "encoding='cp1250'è")]
    assert column(spark, [None if c is None else bytearray(c) for c, _ in cases], T.decode_declared, "binary") == [w for _, w in cases]


def test_index_names_lose_their_comma(spark):
    df = spark.createDataFrame([(0, "Berg, 12"), (1, "Berg, A.,, 12, 13"), (2, "Dal, (3) 4")], "i int, line string")
    assert {r.i: r["name"] for r in rules.parse_person_lines(df).collect()} == {0: "Berg", 1: "Berg, A.", 2: "Dal,"}
    assert {r.i: r.place for r in rules.parse_place_lines(df).collect()}[0] == "Berg"


def test_neighbours_over_chunks(spark):
    rng = random.Random(6)
    values = {c: sorted(rng.sample(range(-5000, 9000), 40)) for c in ("nl", "bl")} | {"x": [7]}
    df = spark.createDataFrame([(c, v) for c, vs in values.items() for v in vs], "corpus string, nr int")
    got = {(r.corpus, r.nr): (r.prev_nr, r.next_nr) for r in carry.neighbours(df, "nr", ["corpus"], chunk=500).collect()}
    assert got == {(c, v): (vs[k - 1] if k else None, vs[k + 1] if k + 1 < len(vs) else None) for c, vs in values.items() for k, v in enumerate(vs)}


def test_survey_and_contexts(spark):
    rows = [("nl", 1, k, t) for k, t in enumerate(["1. Noot", "1598 agent", "5.    Anna", "Iets anders", "   12 ", "", "     tekst", "2.  x"])] + [("nl", 2, 0, "geen")]
    lines = features.surveyed(spark.createDataFrame(rows, "corpus string, page_nr int, line_no int, line string"))
    assert {r.line_no: r.pattern for r in lines.where("page_nr = 1").collect()} == {0: "footnote", 1: "period_header", 2: "footnote", 3: "other", 6: None, 7: "footnote"}
    assert features.survey_pages(lines, spark.createDataFrame([("nl", 1), ("nl", 2), ("bl", 1)], "corpus string, page_nr int")).where("corpus = 'nl'").first()[1:] == (1, 1)
    found = features.note_contexts(spark.createDataFrame([(1, "de rapport12, en x7b. 1593 y"), (2, None)], "i int, text string")).collect()
    assert [(r.pos, r.mark, r.context) for r in found] == [(0, "t12,", "apport12, en x"), (1, "x7b.", ", en x7b. 1593"), (2, "1593 ", "x7b. 1593 y")]


def test_starts_are_wrapped_where_they_stand(spark):
    lines = spark.createDataFrame([(1, "7. Anna Berg werd agent"), (2, 'al <start schuttenr="9">9. Otto</start>'), (3, "8.  Jan Dal"), (4, "niets")], "seq bigint, text string")
    starts = spark.createDataFrame([(7, "Anna Berg"), (9, "9. Otto"), (8, "8. Jan Dal"), (5, None)], "schutte_nr int, start string")
    left = joins.untagged(starts, lines, "schutte_nr")
    assert sorted(r.schutte_nr for r in left.collect()) == [5, 7, 8]
    tagged = {r.seq: r.text for r in sinks.tagged_lines(lines, joins.locate_starts(lines, left, "schutte_nr", "seq", flexible=True), "seq").collect()}
    assert tagged == {1: '7. <start schuttenr="7">Anna Berg</start> werd agent', 2: 'al <start schuttenr="9">9. Otto</start>', 3: '<start schuttenr="8">8.  Jan Dal</start>', 4: "niets"}


def test_hocr(spark):
    w = lambda t, c: f"<span class='ocrx_word' title='bbox 0 0 1 1; x_wconf {c}'>{t}</span>"
    line = lambda x, *ws, k="ocr_line": f"<span class='{k}' title=\"bbox {x} 1 {x + 90} 20\">{' '.join(ws)}</span>\n"
    raw = "<div class='ocr_page' title='image; bbox 0 0 1000 900'>" + line(5, w("lost", 90), k="ocr_header") + line(100, w("A", 79), w("&#39;t", 80)) + line(50, w("absorbed", 10), k="ocr_header") + line(601, w("right", 90)) + line(130, w("B", 95)) + line(230, w(" ", 9)) + line(230, w("C", 95)) + "</div>"
    df = pages.calibrate(pages.hocr_lines(spark.createDataFrame([(1, raw), (2, "nothing")], "page int, content string")), ["page"])
    got = [(r.x, r.text, r.indent, [x.text for x in r.low]) for r in df.withColumn("low", pages.low_confidence(F.col("words"))).orderBy("line_no").collect()]
    assert got == [(100, "A &#39;t absorbed", 0, ["A", "absorbed"]), (130, "B", 5, []), (230, "C", 10, [])]


def serial(lines, toc):
    """The serial scan: current record, period, and notes flushed at entries and page ends."""
    out, notes, periods = [], {}, {}
    current = period = None
    for corpus in sorted({r[0] for r in lines}):
        current = period = None
        own = sorted(r for r in lines if r[0] == corpus)
        for page in sorted({r[1] for r in own}):
            buffer = []

            def flush(to):
                for k, v in buffer:
                    if to is not None:
                        notes[corpus, to, k] = v
                buffer.clear()

            early = []
            for _, _, no, zone, nr, text in (r for r in own if r[1] == page):
                if zone == "period_header":
                    period = text
                elif zone == "footnote":
                    (buffer if current is not None else early).append((str(nr), text))
                elif zone == "lemma_entry":
                    flush(current)
                    if (corpus, nr) in toc:
                        current = nr
                        buffer.extend(early)
                        flush(current)
                        early = []
                        if period and (corpus, nr) not in periods:
                            periods[corpus, nr] = period
                if zone in ("lemma_entry", "body") and current is not None:
                    out.append((corpus, current, page, no))
            flush(current)
    return sorted(out), notes, periods


@pytest.mark.parametrize("seed", range(4))
def test_records_against_the_serial_scan(spark, seed, monkeypatch):
    monkeypatch.setattr(records, "PAGES_A_CHUNK", 3)
    rng = random.Random(seed)
    lines = []
    for corpus in ("nl", "bl"):
        for page in range(12):
            for no in range(rng.randrange(8)):
                zone = rng.choice(["lemma_entry", "footnote", "body", "body", "period_header", "blank"])
                nr = rng.randrange(6)
                lines.append((corpus, page, no, zone, nr, f"{nr}. t{rng.randrange(99)}"))
    toc = {(c, n) for c in ("nl", "bl") for n in range(6) if rng.random() < 0.6}
    df = spark.createDataFrame(lines, "corpus string, page_nr int, line_no int, zone string, nr int, text string").withColumn("fn_nr", F.when(F.col("zone") == "footnote", F.col("nr").cast("string"))).withColumn("fn_text", F.col("text")).withColumn("indent", F.lit(0))
    s = records.sessionize(records.mark_entries(df, spark.createDataFrame(sorted(toc) or [("x", 1)], "corpus string, schutte_nr int")), ["page_nr"], ["line_no"]).cache()
    out, notes, periods = serial(lines, toc)
    assert sorted((r.corpus, r.record_nr, r.page_nr, r.line_no) for r in records.record_lines(s).collect()) == out
    assert {(r.corpus, r.schutte_nr, r.fn_nr): r.fn_text for r in records.attach_notes(s, ["page_nr"], ["line_no"]).collect()} == notes
    assert {(r.corpus, r.schutte_nr): r.period for r in records.record_periods(s, ["page_nr", "line_no"]).collect()} == periods


def test_two_level_carry_equals_one_scan(spark):
    rng = random.Random(8)
    rows = [(rng.choice("ab"), p, k, rng.choice([None, None, None, p * 10 + k])) for p in range(30) for k in range(rng.randrange(5))]
    df = spark.createDataFrame(rows, "part string, page int, k int, v int")
    one = carry.carry_forward(df, F.col("v"), "x", ["part"], ["page", "k"])
    two = carry.two_level_carry(df, F.col("v"), "x", ["part"], ["page"], ["k"])
    three = carry.two_level_carry(df, F.col("v"), "x", ["part"], ["page"], ["k"], F.floor(F.col("page") / 4))
    key = lambda d: sorted(map(tuple, d.select("part", "page", "k", F.coalesce("x", F.lit(-1))).collect()))
    assert key(one) == key(two) == key(three)


def test_islands_never_merge_preformatted(spark):
    zones = ["body", "body", "pre_html", "pre_html", "body"]
    df = spark.createDataFrame([(1, i, z, f"t{i}") for i, z in enumerate(zones)], "id int, seq int, zone string, text string")
    blocks = records.display_blocks(df, ["id"], "seq", lambda a, b: F.concat_ws(" ", a, b)).orderBy("block").collect()
    assert [(b.zone, b.text) for b in blocks] == [("body", "t0 t1"), ("pre_html", "t2"), ("pre_html", "t3"), ("body", "t4")]


def test_references(spark):
    index = spark.createDataFrame([(1, "nl", 5, [3, 9, 3, 7]), (2, "nl", 5, [3]), (3, "nl", 99, [3]), (4, "nl", None, None), (5, "bl", 5, [3])], "person_seq bigint, corpus string, schutte_nr int, pages array<int>")
    entries = spark.createDataFrame([("nl", 5, 3), ("nl", 6, 3), ("nl", 7, 7), ("nl", 8, 0)], "corpus string, schutte_nr int, toc_page int")
    edges = refs.page_references(index, entries).cache()
    assert sorted((r.person_seq, r.schutte_nr, r.pos) for r in edges.collect()) == [(1, 5, 0), (1, 6, 0), (1, 7, 3), (2, 5, 0), (2, 6, 0), (3, 5, 0), (3, 6, 0)]
    assert sorted((r.subject, r.schutte_nr, r.person_seq) for r in refs.mentioned_in(index, edges, entries).collect()) == [(5, 6, 1), (5, 6, 2), (5, 7, 1)]


def test_verify_locate_and_pairs(spark):
    expected = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], "id int, want string")
    present = spark.createDataFrame([(2, None, True), (3, "x", True), (4, "d", True)], "id int, have string, ok boolean")
    got = joins.verify(expected, present, ["id"], F.col("have").isNotNull(), F.col("have") == F.col("want"))
    assert sorted((r.id, r.status) for r in got.collect()) == [(1, "missing"), (2, "unreadable"), (3, "mismatch"), (4, "ok")]
    lines = spark.createDataFrame([(1, "7.   Gideon"), (2, "8. Anna"), (3, "8. Anna")], "seq int, text string")
    starts = spark.createDataFrame([(7, "7. Gideon"), (8, "8. Anna"), (9, "")], "schutte_nr int, start string")
    assert sorted((r.schutte_nr, r.seq) for r in joins.locate_starts(lines, starts, "schutte_nr", "seq").collect()) == [(7, None), (8, 2)]
    found = {r.schutte_nr: r.seq for r in joins.locate_starts(lines, starts, "schutte_nr", "seq", flexible=True).collect()}
    assert found == {7: 1, 8: 2}
    tagged = sinks.tagged_lines(lines, joins.locate_starts(lines, starts, "schutte_nr", "seq", flexible=True), "seq")
    assert sum(r.text.startswith("<start ") for r in tagged.collect()) == 2
    pairs = joins.pair_in_order(lines.withColumn("p", F.lit(1)), starts.select(F.lit(1).alias("p"), F.col("schutte_nr").alias("seq"), "start"), ["p"], "seq")
    assert pairs.count() == 3


def test_sources_and_sinks_round_trip(spark, tmp_path):
    for k in (1, 2):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"page_{k}.html").write_bytes("a é<br>b".encode("utf-8" if k == 1 else "latin-1"))
    df = pages.read_pages(spark, str(tmp_path / "in"), "nl")
    assert sorted((r.source_file, r.line_no, r.line) for r in pages.page_lines(df).collect()) == [("0001", 0, "a é"), ("0001", 1, "b"), ("0002", 0, "a é"), ("0002", 1, "b")]
    out, ckpt = str(tmp_path / "bronze"), str(tmp_path / "ckpt")
    ingest.ingest_pages(spark, str(tmp_path / "in"), out, ckpt, "nl")
    (tmp_path / "in" / "page_3.html").write_bytes(b"c")
    ingest.ingest_pages(spark, str(tmp_path / "in"), out, ckpt, "nl")
    assert sorted(r.source_file for r in spark.read.parquet(out).collect()) == ["0001", "0002", "0003"]
    rows = spark.createDataFrame([(1, "a\tb"), (2, None)], "id int, t string")
    sinks.write_json(rows, str(tmp_path / "j"))
    sinks.write_tsv(rows, str(tmp_path / "t"))
    sinks.write_search_index(rows, str(tmp_path / "s"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2 and spark.read.csv(str(tmp_path / "t"), sep="\t", header=True).count() == 2
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "s")).collect()) == ['{"id":1,"t":"a\\tb"}', '{"id":2}']


def test_segments_and_lines(spark):
    raw = '<root>lost<start schuttenr="7">x</start> a<br><b>c</b><br> <br/><start schuttenr="8">y</start><start schuttenr="7">z</start>last</root>'
    df = pages.split_at_starts(spark.createDataFrame([("nl", raw)], "corpus string, text string"))
    assert sorted((r.schutte_nr, r.segment) for r in df.collect()) == [(7, '<start schuttenr="7">z</start>last'), (8, '<start schuttenr="8">y</start>')]
    lines = pages.block_lines(spark.createDataFrame([(1, "a <br> <b>c</b><page n='1'><br/><br>")], "i int, text string"))
    assert [r.line for r in lines.collect()] == ["a", "c"]


def test_every_query_is_registered_with_its_columns(spark):
    import __spark_entry__ as e

    q, sql = e.queries(), e.oracle_sql()
    assert set(sql) <= set(q) and e.entry(spark).limit(1).count() == 1


def test_metadata(spark, tmp_path):
    from colophon.sources import metadata

    (tmp_path / "m.csv").write_text(" schuttenr ,schutte_nr,name,Intraposition,schutte_beginjaar,derived_beginjaar,derived_eindjaar,url,hyperlink\n5.0,9, Berg ,van,1598.9,1600,0,,h\n,7,x,,,,,,\nca. 3,3,y,,,,,,\n6,,,,0,1610,1620,u,h\n", encoding="utf-8")
    raw = metadata.read_metadata(spark, str(tmp_path / "m.csv"), "nl")
    got = [(r.schutte_nr, r.name, r.intraposition, r.beginjaar, r.eindjaar, r.url, r.givenname) for r in metadata.shape_metadata(raw).orderBy("schutte_nr").collect()]
    assert got == [(5, "Berg", "van", 1598, None, "h", ""), (6, "", "", 1610, 1620, "u", "")]
    assert [r.beginjaar for r in metadata.shape_metadata(raw, "derived").orderBy("schutte_nr").collect()] == [1600, 1610]


def test_command_line_registers_every_query():
    from colophon import __main__ as cli
    from colophon.plans import structure

    assert set(cli.STEPS.values()) <= set(structure.QUERIES)


def test_contents_tables(spark, tmp_path):
    import datetime as dt

    from colophon.plans import structure

    xml = (
        "<toc><item level='0'><title>I. Land &amp; zee</title><item level='1' schutte_nr='3'><title>3. Berg, A.</title><page number='7' source='12'/></item></item>"
        "<item level='1' schutte_nr=' 4 '><title>4. Dal</title><page number='x'/></item><item level='0'><title/></item><item level='2' schutte_nr='5'><title>Los</title></item><item level='1' schutte_nr='6a'/></toc>"
    )
    rows = [(1, "nl", None, "xml", xml, dt.datetime(2020, 1, 1)), (1, "nl", None, "xml", xml, dt.datetime(2020, 1, 2)), (2, "nl", None, "json", None, None)]
    spark.createDataFrame(rows, "toc_id bigint, corpus string, volume string, item_format string, item string, received_at timestamp_ntz").write.parquet(str(tmp_path / "toc.parquet"))
    got = sorted((r.item_seq, r.schutte_nr, r.title, r.chapter, r.page_nr, r.source_file) for r in structure.toc_chapters(spark, str(tmp_path)).collect())
    # an item whose number is none has number 0, so it names the chapter if it has a title
    assert got == [(2, 3, "Berg, A.", "I. Land & zee", 7, "0012"), (3, 4, "Dal", "I. Land & zee", 0, "0001"), (5, 5, "Los", "I. Land & zee", 0, "0001")]
    levels = sorted((r.item_seq, r.schutte_nr, r.chapter_seq, r.chapter, r.slug) for r in structure.toc_levels(spark, str(tmp_path)).collect())
    assert levels == [(2, 3, 1, "I. Land & zee", "land-zee"), (3, 4, 1, "I. Land & zee", "land-zee")]
    direct = sorted((r.item_seq, r.schutte_nr) for r in structure.toc_levels(spark, str(tmp_path), direct=True).collect())
    assert direct == [(3, 4)]


def test_two_readings_side_by_side(spark):
    import difflib

    a, b = "een\ntwee\ndrie\nvier", "een\ntwec\ndrie\nvijf\nzes"
    df = spark.createDataFrame([(a, b), (a, a), (None, b)], "a string, b string")
    rows = df.select(T.similarity("a", "b").alias("s"), T.line_difference("a", "b").alias("d")).collect()
    assert abs(rows[0].s - difflib.SequenceMatcher(None, a, b).ratio()) < 1e-12 and rows[1].s == 1.0 and rows[2].s is None
    assert (rows[0].d.only_left, rows[0].d.only_right) == (["twee", "vier"], ["twec", "vijf", "zes"]) and rows[1].d.only_left == []


def test_locate_parts_of_lines_and_garbled_starts(spark, monkeypatch):
    def mangle(t):
        return t.encode().decode("cp1252", "ignore")

    texts = ["zie 8. Anna", "7. Gideon", "  van Daniël", mangle("9. Jérôme te Wien"), mangle(mangle("10. André")), "x", "11. een", "lange zin", "12.  \t Otto", "", " de Groot", "ab"]
    lines = spark.createDataFrame(list(enumerate(texts, 1)), "seq int, text string").repartition(4)
    starts = spark.createDataFrame([(1, "Anna"), (2, "Gideon\n  van Daniël"), (3, "9. Jérôme"), (4, " 10. André "), (5, "een\nlange zin\n12."), (6, "12. Otto de Groot"), (7, "b"), (8, "nergens"), (9, "  "), (10, None), (11, "Gideon")], "nr int, start string")
    for size in (8, 16_384):
        monkeypatch.setattr(joins, "CHUNK", size)
        exact = {r.nr: r.seq for r in joins.locate_starts(lines, starts, "nr", "seq").collect()}
        assert exact == {1: 1, 2: 2, 3: 4, 4: 5, 5: 7, 6: None, 7: 12, 8: None, 11: 2}
    loose = {r.nr: r.seq for r in joins.locate_starts(lines, starts, "nr", "seq", flexible=True).collect()}
    assert loose == {**exact, 6: 9}


def test_locate_against_plain_search(spark, monkeypatch):
    rng = random.Random(5)
    monkeypatch.setattr(joins, "CHUNK", 60)
    texts = ["".join(rng.choice("abc é") for _ in range(rng.randrange(40))) for _ in range(120)]
    whole = "\n".join(texts) + "\n"
    places = [sum(len(t) + 1 for t in texts[:k]) for k in range(len(texts))]
    starts = [(k, whole[at : at + rng.choice([1, 2, 3, 5, 9, 20, 24, 25, 60, 150])]) for k, at in enumerate(rng.sample(range(len(whole) - 160), 200))]
    starts += [(200 + k, "".join(rng.choice("abc") for _ in range(n))) for k, n in enumerate((1, 2, 3, 4, 5, 6, 7, 8))]
    got = {r.nr: r.seq for r in joins.locate_starts(spark.createDataFrame(list(enumerate(texts)), "seq bigint, text string"), spark.createDataFrame(starts, "nr int, start string"), "nr", "seq").collect()}

    def first(x):
        for v in (x, x.encode().decode("cp1252", "ignore")):
            if (at := whole.find(v)) >= 0:
                return bisect.bisect_right(places, at) - 1

    assert got == {k: first(x.strip()) for k, x in starts if x.strip()}


def test_common_names_lead_to_few_chunks(spark, monkeypatch):
    rng, kept, cut = random.Random(7), [], joins.cut
    monkeypatch.setattr(joins, "CHUNK", 100)
    monkeypatch.setattr(joins, "cut", lambda df: kept.append(cut(df)) or kept[-1])
    texts = ["Nicolaas van der " + "".join(rng.sample("bcdfghklmnprstvwz", 6)) + ", gezant" for _ in range(200)]
    starts = spark.createDataFrame([(k, t[1:24]) for k, t in enumerate(texts[:100])], "nr int, start string")
    got = joins.locate_starts(spark.createDataFrame(list(enumerate(texts)), "seq int, text string"), starts, "nr", "seq").collect()
    assert {r.nr: r.seq for r in got} == {k: k for k in range(100)}
    # what of the text is held against starts: not the names that stand in every chunk
    held = next(d for d in kept if "chunk" in d.columns and "text" not in d.columns)
    assert held.count() <= 2 * 100


def test_starts_of_every_length_and_none(spark):
    text = "é" + "".join(random.Random(8).choice("abcdefghij ") for _ in range(400)) + "z"
    lines = spark.createDataFrame([(1, "niets"), (2, text)], "seq int, text string")
    starts = [(n, text[:n].strip()) for n in range(1, 150)] + [(200 + n, text[-n:].strip()) for n in range(1, 150)] + [(500, text + "x")]
    got = {r.nr: r.seq for r in joins.locate_starts(lines, spark.createDataFrame(starts, "nr int, start string"), "nr", "seq").collect()}
    assert got == {k: 2 if k != 500 else None for k, _ in starts}
    assert joins.locate_starts(lines, spark.createDataFrame([(1, " "), (2, None)], "nr int, start string"), "nr", "seq").collect() == []


def test_older_citations_of_van_der_aa(spark):
    said = [
        "zie Aa, Biogr. Woordenb. der Nederlanden, dl. IV, 123 en nnbw iv, 5", "A.a. biogr woordenb, d. 12, 7", "AA, BIOGR. WOORDENB., dl. x, 8", "Aa, Biogr. Woordenb., dl. XI, 9", "Aa, Biogr. Woordenb. der Nederlanden, IV",
        "Aa, Biogr. Woordenb.; Aa, Biogr. Woordenb., 007, 3", None,
    ]
    link = lambda path, volume, page, text: f'<a href="https://example.org/{path}/#source={volume}&page={page}">{text}</a>'
    assert column(spark, said, T.link_citations_loosely) == [
        "zie " + link("vdaa", 4, 123, "Aa, Biogr. Woordenb. der Nederlanden, dl. IV, 123") + " en " + link("nnbw", 4, 5, "nnbw iv, 5"), link("vdaa", 12, 7, said[1]), link("vdaa", 10, 8, said[2]), said[3], said[4],
        "Aa, Biogr. Woordenb.; " + link("vdaa", 7, 3, "Aa, Biogr. Woordenb., 007, 3"), None,
    ]
    got = column(spark, ["Aa, Biogr. Woordenb., 2, 3"], lambda c: T.link_citations_loosely(c, resolver="https://bp.example/resolver?url="))
    assert got == [link("vdaa", 2, 3, "Aa, Biogr. Woordenb., 2, 3") + ' <a class="bp-resolver" href="https://bp.example/resolver?url=https%3A%2F%2Fexample.org%2Fvdaa%2F%23source%3D2%26page%3D3" title="Biografisch Portaal">[BP]</a>']
