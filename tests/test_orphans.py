import datetime as dt
import random

from pyspark.sql import functions as F

from colophon.operators import orphans

T = [dt.datetime(2020, 1 + m, 5, 12) for m in range(12)]
REF = "corpus string, id bigint, nr int, received_at timestamp_ntz, state string"
TGT = "corpus string, nr int, received_at timestamp_ntz, deleted_at timestamp_ntz"


def run(spark, refs, targets, hot=orphans.HOT_ROWS):
    r, t = spark.createDataFrame(refs, REF), spark.createDataFrame(targets, TGT)
    found = orphans.orphan_references(orphans.references(r, "r", "f", "t", "id", F.col("corpus"), F.col("nr")), orphans.targets(t, "t", "nr"), hot)
    return sorted(tuple(x) for x in found.select("ref_id", "target_corpus", "target_nr", "state", "ref_month").collect())


def brute(refs, targets):
    first, known = {}, {}
    for c, i, n, ts, _ in refs:
        if c is not None and n is not None:
            first[c, i, n] = min(filter(None, (first.get((c, i, n)), ts)), default=None)
    for c, n, ts, gone in targets:
        if c is not None and n is not None:
            old = known.get((c, n), (None, False))
            known[c, n] = (min(filter(None, (old[0], ts)), default=None), old[1] or gone is not None)
    out = []
    for (c, i, n), ts in first.items():
        t = known.get((c, n))
        state = "missing" if t is None else "deleted" if t[1] else "late" if ts and t[0] and t[0] > ts else None
        if state:
            out.append((i, c, n, state, ts and ts.strftime("%Y-%m")))
    return sorted(out)


def test_against_brute_force(spark):
    rng = random.Random(5)
    key = lambda: rng.choice([rng.randrange(40), rng.randrange(-5, 5), 32766 + rng.randrange(5), 2**31 - 1])
    corpora = ["nl", "bl", None]
    refs = [(rng.choice(corpora), rng.randrange(60), rng.choice([key(), None]), rng.choice(T), "x") for _ in range(400)]
    refs += refs[:50] + [("nl", i, 3, T[i % 12], None) for i in range(100, 400)]  # a hot key
    targets = [(rng.choice(corpora), key(), rng.choice([*T, None]), rng.choice([None, None, T[0]])) for _ in range(60)]
    assert run(spark, refs, targets) == brute(refs, targets)
    # hot keys are split: every key named more than ten times in a month
    assert run(spark, refs, targets, 10) == brute(refs, targets)


def test_empty_sides(spark):
    assert run(spark, [], [("nl", 1, T[0], None)]) == []
    assert run(spark, [("nl", 1, 9, T[3], None)], []) == [(1, "nl", 9, "missing", "2020-04")]


def test_record_without_time_is_never_late(spark):
    assert run(spark, [("nl", 1, 9, None, None), ("nl", 1, 8, None, None)], [("nl", 9, T[1], None)]) == [(1, "nl", 8, "missing", None)]


def test_same_month_is_decided_by_the_exact_time(spark):
    later = T[2] + dt.timedelta(hours=1)
    assert run(spark, [("nl", 1, 9, T[2], None), ("nl", 2, 9, later, None)], [("nl", 9, later, None)]) == [(1, "nl", 9, "late", "2020-03")]
