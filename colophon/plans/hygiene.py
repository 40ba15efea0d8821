"""Queries of the general training-data problems: nested records (1) and references to nothing (4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colophon.operators import orphans, shred
from colophon.session import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shred.shred_items(table(spark, sf_dir, "toc"))


def p1_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide item table: every leaf that an item has once, its depth, and its first page."""
    return shred.shred_items(table(spark, sf_dir, "toc"), wide=True)


def p1_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages of items, with the link to their item."""
    return shred.shred_table(table(spark, sf_dir, "toc"), "pages")


def p1_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbers that items list, with the link to their item."""
    return shred.shred_table(table(spark, sf_dir, "toc"), "numbers")


def _all_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    persons = table(spark, sf_dir, "persons_index")
    pages = persons.select("person_seq", "corpus", "received_at", F.explode("pages").alias("nr"))
    entries = persons.select("person_seq", "received_at", F.explode("appears_in").alias("ref"))
    lemma = table(spark, sf_dir, "lemma")
    return (
        orphans.references(pages, "persons_index", "pages", "page_html", "person_seq", F.col("corpus"), F.col("nr"))
        .unionByName(orphans.references(entries, "persons_index", "appears_in", "lemma", "person_seq", F.col("ref.corpus"), F.col("ref.schutte_nr")))
        .unionByName(orphans.references(lemma, "lemma", "schutte_nr", "toc_flat", "lemma_id", F.col("corpus"), F.col("schutte_nr")))
    )


def _all_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        orphans.targets(table(spark, sf_dir, "page_html"), "page_html", "page_nr")
        .unionByName(orphans.targets(table(spark, sf_dir, "lemma"), "lemma", "schutte_nr"))
        .unionByName(orphans.targets(table(spark, sf_dir, "toc_flat"), "toc_flat", "schutte_nr"))
    )


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphans.orphan_references(_all_references(spark, sf_dir), _all_targets(spark, sf_dir))


def p4_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphans.orphan_report(p4_found(spark, sf_dir))


_P4 = """
with refs as (
  select ref_table, ref_field, target, ref_id, target_corpus, target_nr, min(ts) as ref_ts from (
    select 'persons_index' as ref_table, 'pages' as ref_field, 'page_html' as target, person_seq as ref_id, corpus as target_corpus, unnest(pages) as target_nr, received_at as ts from persons_index
    union all
    select 'persons_index', 'appears_in', 'lemma', person_seq, a.corpus, a.schutte_nr, received_at from (select person_seq, received_at, unnest(appears_in) as a from persons_index)
    union all
    select 'lemma', 'schutte_nr', 'toc_flat', lemma_id, corpus, schutte_nr, received_at from lemma)
  where target_corpus is not null and target_nr is not null group by all),
targets as (
  select target, corpus as target_corpus, nr as target_nr, min(received_at) as t_ts, bool_or(deleted_at is not null) as gone from (
    select 'page_html' as target, corpus, page_nr as nr, received_at, deleted_at from page_html
    union all select 'lemma', corpus, schutte_nr, received_at, deleted_at from lemma
    union all select 'toc_flat', corpus, schutte_nr, received_at, deleted_at from toc_flat) group by all),
found as (
  select ref_table, ref_field, ref_id, r.target_corpus, r.target_nr,
    case when gone is null then 'missing' when gone then 'deleted' when t_ts > ref_ts then 'late' end as state, strftime(ref_ts, '%Y-%m') as ref_month
  from refs r left join targets t on r.target = t.target and r.target_corpus = t.target_corpus and r.target_nr = t.target_nr)
"""

QUERIES = {"p1_found": p1_found, "p1_items": p1_items, "p1_pages": p1_pages, "p1_numbers": p1_numbers, "p4_found": p4_found, "p4_report": p4_report}

SQL = {
    "p4_found": _P4 + "select * from found where state is not null",
    "p4_report": _P4 + "select ref_table, ref_field, ref_month, state, count(*) as n_refs, count(distinct (target_corpus, target_nr)) as n_targets from found where state is not null group by all",
}
