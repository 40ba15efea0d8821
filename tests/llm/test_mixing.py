import numpy as np

from colophon.llm import mixing

DOC = "doc_id bigint, source string, n_tokens bigint"
MIX = "mix_name string, source string, target_share double, max_repeats int"


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 3, 50, 700):
        size, p = rng.integers(0, 900, n), rng.random(n)
        out = mixing.flight(p, size, rng)
        undecided = ((out > 1e-9) & (out < 1 - 1e-9)).sum()
        assert undecided <= 2 and (out > -1e-9).all() and (out < 1 + 1e-9).all()
        assert np.isclose(out.sum(), p.sum()) and np.isclose((out * size).sum(), (p * size).sum())
    same = mixing.flight(np.full(9, 0.4), np.full(9, 7), rng)
    assert np.isclose(same.sum(), 3.6)


def test_flight_is_unbiased():
    size, p = np.array([5, 9, 2, 7, 1, 8]), np.array([0.2, 0.5, 0.7, 0.4, 0.9, 0.3])
    mean = np.mean([mixing.flight(p, size, np.random.default_rng(s)) for s in range(3000)], axis=0)
    assert np.abs(mean - p).max() < 0.05


def run(spark, docs, targets, block):
    uses, goal = mixing.mix(spark.createDataFrame(docs, DOC), spark.createDataFrame(targets, MIX), block=block)
    return uses.collect(), {(r.mix_name, r.source): r for r in mixing.shares(uses, goal).collect()}


def test_shares_caps_and_many_blocks(spark):
    rng = np.random.default_rng(3)
    docs = [(i, "abc"[i % 7 % 3], int(rng.integers(1, 300))) for i in range(1500)]
    targets = [("m", "a", 0.6, 3), ("m", "b", 0.3, 1), ("m", "gone", 0.1, 5), ("n", "c", 1.0, 2), ("n", "a", 0.0, None)]
    for block in (64, 4096):
        uses, report = run(spark, docs, targets, block)
        assert len({(u.mix_name, u.doc_id) for u in uses}) == len(uses)
        assert max(u.copies for u in uses if u.source == "a") <= 3 and max(u.copies for u in uses if u.source == "b") <= 1
        assert report["m", "gone"].state == "absent" and report["m", "gone"].reached_share == 0
        assert abs(report["m", "a"].reached_share - 2 / 3) < 0.005 and abs(report["m", "b"].reached_share - 1 / 3) < 0.005
        assert report["n", "c"].reached_share == 1 and report["n", "c"].most_copies == 2
        assert report["n", "a"].state == "absent"
        # the source that binds is used to its cap
        assert report["m", "a"].tokens_used == 3 * report["m", "a"].tokens or report["m", "b"].tokens_used == report["m", "b"].tokens


def test_empty_tables(spark):
    assert run(spark, [], [("m", "a", 1.0, 1)], 64)[0] == []
    assert run(spark, [(1, "a", 5)], [], 64) == ([], {})
    assert run(spark, [(1, "a", 0)], [("m", "a", 1.0, 1)], 64)[0] == []
