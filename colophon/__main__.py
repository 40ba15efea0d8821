"""python -m colophon {assemble|tag|extract|verify|all|QUERY} SF_DIR OUT: run a step or a registered query and write its table."""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import SparkSession

from colophon.plans import hygiene, structure

STEPS = {"assemble": "corpus_pages", "tag": "start_locations", "extract": "entry_xml", "verify": "verify_report"}


def main(argv: list[str] | None = None) -> None:
    queries = {**structure.QUERIES, **hygiene.QUERIES}
    more = argparse.ArgumentParser(add_help=False)
    more.add_argument("--queries", action="append", default=[], metavar="MODULE", help="a module whose QUERIES are added, such as that of a subpackage")
    known, _ = more.parse_known_args(argv)
    for module in known.queries:
        queries |= importlib.import_module(module).QUERIES
    parser = argparse.ArgumentParser(prog="colophon", description=__doc__, parents=[more])
    parser.add_argument("step", choices=[*STEPS, "all", *queries])
    parser.add_argument("sf_dir")
    parser.add_argument("out")
    parser.add_argument("--corpus", choices=["nl", "bl"], help="only this corpus")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("colophon").getOrCreate()
    for step in [*STEPS] if args.step == "all" else [args.step]:
        df = queries[STEPS.get(step, step)](spark, args.sf_dir)
        if args.corpus and "corpus" in df.columns:
            df = df.where(df.corpus == args.corpus)
        df.write.mode("overwrite").parquet(f"{args.out}/{step}")


if __name__ == "__main__":
    main()
