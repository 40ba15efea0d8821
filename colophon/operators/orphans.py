"""References without a valid target, by bitmap difference (problem 4).

Keys are integers within a corpus and a target table.  Per key range (2^15 keys) and month one bitmap holds the keys referred to, another the
keys of valid targets first seen in that month.  ``reference AND NOT (valid targets of earlier months)`` leaves the keys that
can lack a target; only these surviving bits are decoded and joined back to the referring records, where the exact times decide.
Bitmaps are built with map-side combination, so a key that a third of all references name costs one bit, and they cross the
shuffle under the session's compression codec, which squeezes the empty ranges.  In the join back, keys that more than a fixed part of all
references name are split, by their counts; there can be no more of them than that part allows.

Defined results: null arrays, null elements and a null corpus or number refer to nothing; a repeated element or delivery counts
once; a record without any time has a null month and is never late.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colophon.session import cut

RANGE_BITS = 15
# a key is hot that holds this part of all references, and so many at least; it is split into parts of that size
HOT_SHARE, HOT_ROWS = 1e-4, 100_000


def month_index(ts: Column) -> Column:
    return F.coalesce(F.year(ts) * 12 + F.month(ts) - 1, F.lit(-1)).cast("int")


def references(rows: DataFrame, ref_table: str, ref_field: str, target: str, ref_id: str, corpus: Column, nr: Column, ts: str = "received_at") -> DataFrame:
    """Uniform reference rows; ``rows`` has one row per mention, ``target`` names the referred table."""
    return rows.select(
        F.lit(ref_table).alias("ref_table"), F.lit(ref_field).alias("ref_field"), F.lit(target).alias("target"), F.col(ref_id).cast("bigint").alias("ref_id"),
        corpus.alias("target_corpus"), nr.cast("int").alias("target_nr"), F.col(ts).alias("ref_ts"),
    ).where("target_corpus is not null and target_nr is not null")


def targets(rows: DataFrame, target: str, nr: str, ts: str = "received_at", deleted: str = "deleted_at") -> DataFrame:
    return rows.select(F.lit(target).alias("target"), F.col("corpus").alias("target_corpus"), F.col(nr).cast("int").alias("target_nr"), F.col(ts).alias("t_ts"), F.col(deleted).isNotNull().alias("gone"))


def _bitmaps(rows: DataFrame, month: Column, name: str) -> DataFrame:
    # arithmetic shift and mask hold for negative keys too
    return (
        rows.select("target", "target_corpus", F.shiftright("target_nr", RANGE_BITS).alias("bucket"), month.alias("month"), F.col("target_nr").bitwiseAND(F.lit((1 << RANGE_BITS) - 1)).cast("bigint").alias("bit"))
        .groupBy("target", "target_corpus", "bucket", "month")
        .agg(F.bitmap_construct_agg("bit").alias(name))
    )


def _and_not(key: tuple, refs: pd.DataFrame, valid: pd.DataFrame) -> pd.DataFrame:
    target, corpus, bucket = key
    months, out_nr, out_month = sorted(zip(valid["month"], valid["bits"])), [], []
    seen, at = np.zeros(1 << (RANGE_BITS - 3), dtype=np.uint8), 0
    for month, bits in sorted(zip(refs["month"], refs["bits"])):
        while at < len(months) and months[at][0] < month:
            part = np.frombuffer(months[at][1], dtype=np.uint8)
            seen[: len(part)] |= part
            at += 1
        own = np.frombuffer(bits, dtype=np.uint8)
        left = own & ~seen[: len(own)]
        alive = np.flatnonzero(np.unpackbits(left, bitorder="little"))
        out_nr.append(alive + (int(bucket) << RANGE_BITS))
        out_month.append(np.full(len(alive), month))
    if not out_nr:
        return pd.DataFrame({"target": [], "target_corpus": [], "target_nr": [], "month": []}).astype({"target": str, "target_corpus": str, "target_nr": "int32", "month": "int32"})
    nr = np.concatenate(out_nr).astype(np.int32)
    return pd.DataFrame({"target": target, "target_corpus": corpus, "target_nr": nr, "month": np.concatenate(out_month).astype(np.int32)})


def orphan_references(refs: DataFrame, parents: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Distinct references whose target is missing, deleted or later than the reference; see the module text."""
    # used twice: made once
    refs = cut(refs.groupBy("ref_table", "ref_field", "target", "ref_id", "target_corpus", "target_nr").agg(F.min("ref_ts").alias("ref_ts")).withColumn("month", month_index(F.col("ref_ts"))))
    parents = parents.where("target_corpus is not null and target_nr is not null").groupBy("target", "target_corpus", "target_nr").agg(F.min("t_ts").alias("t_ts"), F.max("gone").alias("gone"))
    key = ["target", "target_corpus", "target_nr"]
    named_keys = cut(refs.groupBy(*key, "month").agg(F.count("*").alias("_n")))
    named = _bitmaps(named_keys, F.col("month"), "bits").groupBy("target", "target_corpus", "bucket")
    valid = _bitmaps(parents.where("not gone and t_ts is not null"), month_index(F.col("t_ts")), "bits").groupBy("target", "target_corpus", "bucket")
    alive = named.cogroup(valid).applyInPandas(_and_not, "target string, target_corpus string, target_nr int, month int")
    part = max(hot_rows, int((named_keys.agg(F.sum("_n")).first()[0] or 0) * HOT_SHARE))
    hot = F.broadcast(named_keys.where(F.col("_n") > part).select(*key, "month", F.ceil(F.col("_n") / part).cast("int").alias("_parts")))
    split = lambda rows: rows.join(hot, [*key, "month"], "left").withColumn("_parts", F.coalesce("_parts", F.lit(1)))
    judged = split(alive.join(parents, key, "left")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
    return (
        split(refs).withColumn("salt", F.pmod(F.xxhash64("ref_id"), F.col("_parts")).cast("int"))
        .join(judged, [*key, "month", "salt"])
        .withColumn("state", F.when(F.col("gone").isNull(), "missing").when(F.col("gone"), "deleted").when(F.col("t_ts") > F.col("ref_ts"), "late"))
        .where("state is not null")
        .select("ref_table", "ref_field", "ref_id", "target_corpus", "target_nr", "state", F.when(F.col("month") >= 0, F.format_string("%04d-%02d", (F.col("month") / 12).cast("int"), F.col("month") % 12 + 1)).alias("ref_month"))
    )


def orphan_report(found: DataFrame) -> DataFrame:
    """Orphans per referring table, field, month and state."""
    return found.groupBy("ref_table", "ref_field", "ref_month", "state").agg(F.count("*").alias("n_refs"), F.countDistinct("target_corpus", "target_nr").alias("n_targets"))
