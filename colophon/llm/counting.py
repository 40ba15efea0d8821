"""Counting in one pass over the scan: several counters are fed from the same batches, and their rows meet in one aggregation.

A task hands its counts on whenever they are many, so it holds a bounded number of them; what one task counts twice is added up after
the shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "kind string, source string, a string, b string, c string, n bigint"
FLUSH = 200_000
# of pairs of characters or words only those are sent to the driver that make up this part of all: a million at most, at any size
PAIR_SHARE = 1e-6
# rows that a table sent to all workers may have
MOST_ROWS = 2_000_000

# of a batch, adds to counts under (kind, source, a, b, c)
Feed = Callable[[pa.RecordBatch, Counter], None]


def _rows(counts: Counter) -> pa.RecordBatch:
    columns = list(zip(*counts)) or [()] * 5
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in columns), pa.array(list(counts.values()), pa.int64())], names=["kind", "source", "a", "b", "c", "n"])


def _count(it: Iterator[pa.RecordBatch], feeds: list[Feed]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in it:
        for feed in feeds:
            feed(batch, counts)
        if len(counts) > FLUSH:
            yield _rows(counts)
            counts.clear()
    yield _rows(counts)


def counted(rows: DataFrame, feeds: list[Feed]) -> DataFrame:
    """One row for everything counted."""
    return rows.mapInArrow(lambda it: _count(it, feeds), SCHEMA).groupBy("kind", "source", "a", "b", "c").agg(F.sum("n").alias("n"))


def pairs(counts: DataFrame, kind: str, share: float = PAIR_SHARE) -> dict[tuple[str, str], int]:
    """The pairs (b, c) of a kind over all sources; rare ones stay away, so at most ``1 / share`` come to the driver."""
    own = counts.where(F.col("kind") == kind).groupBy("b", "c").agg(F.sum("n").alias("n"))
    total = counts.where(F.col("kind") == kind).agg(F.sum("n")).first()[0] or 0
    return {(r.b, r.c): r.n for r in own.where(F.col("n") >= share * total).collect()}


def bounded(rows: DataFrame, what: str, most: int = MOST_ROWS) -> list:
    """Collected rows of a table that has to be small; an error, not a cut, if it is not."""
    got = rows.limit(most + 1).collect()
    if len(got) > most:
        raise ValueError(f"more than {most} {what}: too many to send to every worker")
    return got
