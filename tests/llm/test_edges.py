"""Every operator on rows that are null in every column, very long, repeated, tied, and beside columns with clashing names."""

import pytest

from colophon.llm import garbled, lookalike, mixing, names, ocr, spans, tokens

LEMMA = (
    "lemma_id bigint, corpus string, toc_title string, toc_chapter string, toc_page int, name string, givenname string, intraposition string, postposition string, category string, beginjaar int, eindjaar int, "
    "lines array<struct<zone string, text string, indent int, seq int>>, footnotes map<string,string>, text string, id int, key string, root string, keys string, tokens string, kind string, a int, b int, n int, source string, unit string, field_name string, word string, h int, c int"
)
CLASH = (7, "k", "r", "x", "t", "k", 1, 2, 3, "s", "u", "f", "w", 1, 2)
LONG = "de resident schreef één brief zonder gulden. " * 8000


def lemma_rows():
    nothing = (None,) * 15
    body = [("body", "een regel met een woord", 3, 1), None, ("body", None, None, None), (None, "nog een", 0, 2)]
    full = ("nl", "Berg, Otto van", "I. Land", 3, "Berg", "Otto", "van", None, "agent", 1650, 1660, body, {"1": "noot", "2": None}, "een regel\nen nog een")
    rows = [(*nothing, *CLASH), (1, *full, *CLASH), (1, *full, *CLASH), (2, *full, *CLASH)]
    rows += [(3, "nl", None, None, None, LONG[:3000], "x" * 3000, None, None, "agent", None, None, [("body", LONG, 1, 1)], {"1": LONG}, LONG + "Ã©​", *CLASH)]
    rows += [(4, None, "", "", 0, "", "", "", "", "", 0, 0, [], {}, "", *CLASH)]
    return rows


@pytest.fixture(scope="module")
def lemma(spark):
    return spark.createDataFrame(lemma_rows(), LEMMA).cache()


def test_garbled_and_lookalike(lemma):
    assert [tuple(r) for r in garbled.garbled_values(lemma).collect()] == [(3, "text")]
    assert [tuple(r) for r in lookalike.disguised_values(lemma).collect()] == [(3, "text")]
    for made in (garbled.restored_values(lemma), lookalike.unified_values(lemma)):
        rows = {r.lemma_id: r.text for r in made.collect()}
        assert len(rows) == 5 and rows[None] is None and rows[4] == "" and "é" in rows[3]


def test_scan_noise(lemma):
    assert ocr.scan_noise(lemma).columns == ["lemma_id", "field_name", "item_key", "kind"]
    assert ocr.scan_noise(lemma).count() == 0
    clean = ocr.clean_paragraphs(lemma).where("lemma_id = 3 and field_name = 'lines'").first().clean
    assert clean == LONG.strip()


def test_names(lemma):
    assert [tuple(r) for r in names.linked_pairs(lemma).collect()] == [(1, 2)]
    sizes = {r.lemma_id: r.n_entries for r in names.linked_groups(lemma).collect()}
    assert sizes[1] == sizes[2] == 2


def test_documents(spark):
    rows = [(None, None, None, 1, 2, "x"), (1, LONG, "a", 1, 2, "x"), (1, LONG, "a", 1, 2, "x"), (2, LONG[5:9000], "a", 1, 2, "x"), (3, "", "b", 1, 2, "x"), (4, None, None, 1, 2, "x"), (None, LONG, "a", 1, 2, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, h int, c int, kind string").selectExpr("*", "1 as ids", "2 as n_tokens", "3 as p", "4 as f")
    got = sorted(tuple(r) for r in spans.shared_spans(df).collect())
    # the text repeats with a period, so nearly all of it stands in the other document too
    assert got == [(1, 0, len(LONG)), (2, 0, 8995)]
    amounts = {r.doc_id: r.shared_part for r in spans.shared_amount(df, spans.shared_spans(df)).collect()}
    assert amounts == {1: 1.0, 2: 1.0, 3: 0.0, 4: 0.0}
    if __import__("os").path.exists(tokens.vocabulary("byte_bpe_50k.tiktoken")):
        ids = tokens.encode_corpus(df).collect()
        assert len(ids) == 7 and sum(not r.ids for r in ids) == 3
        uses, goal = mixing.mix(mixing.sized_documents(df), spark.createDataFrame([("m", "a", 1.0, 2), (None, "a", 1.0, 1), ("m", None, 1.0, 1)], "mix_name string, source string, target_share double, max_repeats int"))
        assert sorted((r.doc_id, r.copies) for r in uses.collect()) == [(1, 2), (2, 2)]
