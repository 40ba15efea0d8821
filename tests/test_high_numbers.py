"""Entries whose number times 100,000 is no int: the printed lines keep their places, as in SQL."""

import datetime as dt

import duckdb
import pytest

from colophon.plans import structure

NUMBERS = (9, 21474, 21475, 30000)


@pytest.fixture(scope="module")
def high(spark, tmp_path_factory):
    d, at = str(tmp_path_factory.mktemp("high")), dt.datetime(2024, 1, 1)
    line = lambda zone, text, indent, seq: (zone, text, indent, seq)
    lemma = [
        (k, "nl", nr, "Anna Berg", "Gezanten", 8 + k // 2, "1598-1600 agent", "Berg", "Anna", None, 1598, 1600, "agent", [line("body", f"{nr}. Anna Berg, agent", 0, 1), line("body", "werd agent", 2, 2), line("genealogy", "Zoon van Otto", 7, 3)], {"1": "Res. fol. 3", "2a": "Zie daar"}, at)
        for k, nr in enumerate(NUMBERS)
    ]
    kinds = "lemma_id bigint, corpus string, schutte_nr int, toc_title string, toc_chapter string, toc_page int, period string, name string, givenname string, intraposition string, beginjaar int, eindjaar int, functie string, lines array<struct<zone string, text string, indent int, seq int>>, footnotes map<string,string>, received_at timestamp"
    spark.createDataFrame(lemma, kinds).write.parquet(f"{d}/lemma.parquet")
    toc = [("nl", k, nr, f"{nr}. Anna Berg", "Anna Berg", "Gezanten", 8 + k // 2, at) for k, nr in enumerate(NUMBERS)]
    spark.createDataFrame(toc, "corpus string, item_seq int, schutte_nr int, title string, full_title string, chapter string, page_nr int, received_at timestamp").write.parquet(f"{d}/toc_flat.parquet")
    index = [(1, "nl", "Berg, Anna", 30000, [9, 8], at), (2, "nl", "Dal, Jan", None, [8], at)]
    spark.createDataFrame(index, "person_seq bigint, corpus string, name string, schutte_nr int, pages array<int>, received_at timestamp").write.parquet(f"{d}/persons_index.parquet")
    return d


def against_sql(spark, d, name):
    con = duckdb.connect()
    for t in ("lemma", "toc_flat", "persons_index"):
        con.execute(f"create view {t} as select * from '{d}/{t}.parquet/*.parquet'")
    got = structure.QUERIES[name](spark, d)
    ran = con.execute(structure.SQL[name])
    have = [c[0] for c in ran.description]
    assert sorted(have) == sorted(got.columns)
    rows = sorted(map(tuple, got.select(*have).collect()), key=repr)
    assert rows == sorted(ran.fetchall(), key=repr)
    return rows


def test_corpus_pages(spark, high):
    assert [r[1] for r in against_sql(spark, high, "corpus_pages")] == [8, 9]


def test_record_notes(spark, high):
    # a number of four figures begins a period, so all notes are those of entry 9
    assert against_sql(spark, high, "record_notes") == [("nl", 9, "1", "Res. fol. 3"), ("nl", 9, "2a", "Zie daar")]


def test_records_nested(spark, high):
    assert len(against_sql(spark, high, "records_nested")) == len(NUMBERS)


def test_line_zones(spark, high):
    assert len(against_sql(spark, high, "line_zones")) == 6 * len(NUMBERS)


def test_record_periods(spark, high):
    assert against_sql(spark, high, "record_periods")


def test_record_lines(spark, high):
    assert {r[3] // 100000 for r in against_sql(spark, high, "record_lines")} >= {30000}


def test_records_enriched(spark, high):
    assert len(against_sql(spark, high, "records_enriched")) == len(NUMBERS)
