import random

import pytest

from colophon.llm import names

SCHEMA = "lemma_id bigint, corpus string, toc_title string, name string, givenname string, intraposition string, postposition string, category string, beginjaar int, eindjaar int"


def entry(i, name, given, first=1650, last=1660, title=None, post=None, kind="agent", corpus="nl"):
    return (i, corpus, title, name, given, None, post, kind, first, last)


def pairs(spark, rows):
    return sorted(tuple(r) for r in names.linked_pairs(spark.createDataFrame(rows, SCHEMA)).collect())


def test_distance_against_plain_recursion():
    from functools import lru_cache

    @lru_cache(None)
    def osa(a, b):
        if not a or not b:
            return len(a) + len(b)
        best = min(osa(a[1:], b) + 1, osa(a, b[1:]) + 1, osa(a[1:], b[1:]) + (a[0] != b[0]))
        return min(best, osa(a[2:], b[2:]) + 1) if a[:2] == b[:2][::-1] and len(a) > 1 and len(b) > 1 else best

    rng = random.Random(1)
    for _ in range(600):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randrange(7))) for _ in range(2))
        for most in (0, 1, 2):
            assert names.distance(a, b, most) == min(osa(a, b), most + 1)


def test_index_finds_every_near_key(spark):
    rng = random.Random(2)
    keys = sorted({"".join(rng.choice("abcd") for _ in range(rng.randrange(3, 10))) for _ in range(150)})
    # keys longer than what is indexed, with slips before, at and after its end
    for _ in range(60):
        k = "".join(rng.choice("abcd") for _ in range(rng.randrange(names.PREFIX - 2, names.PREFIX + 8)))
        keys.append(k)
        for _ in range(rng.randrange(3)):
            i = rng.randrange(len(k))
            k = rng.choice([k[:i] + k[i + 1 :], k[:i] + rng.choice("abcd") + k[i:], k[:i] + rng.choice("abcd") + k[i + 1 :], k[:i] + k[i : i + 2][::-1] + k[i + 2 :]])
        keys.append(k)
    keys = sorted(set(keys))
    df = spark.createDataFrame([(k,) for k in keys], "key string")
    got = {tuple(r) for r in names.near_keys(df).collect()}
    want = {(a, b) for a in keys for b in keys if a != b and names.distance(a, b, s := names.slack(min(len(a), len(b)))) <= s}
    assert got == want


@pytest.mark.parametrize("a, b", [("Hans", "Johannes"), ("J.", "Johannes"), ("Nic.", "Nicolaas"), ("Gerh.", "Gerard"), ("Wm.", "Wilhelmus"), ("Theodorus", "Theodorus Ulrich"), ("T. U.", "Theodorus Ulrich"), ("Ulrich Theodorus", "Theodorus Ulrich"), ("mr. Otto", "Ottto"), ("Ren�", "René"), ("Günther", "Gunther"), ("", "Otto"), ("Thérèse", "Théèse"), ("Eerard", "Everard"), ("Laruens", "Laurens"), ("Ren�", "Reé"), ("Otto", "Oto")])
def test_given_names_that_fit(a, b):
    x, y = (tuple(names.parts("Berg", v, None, False)[1]) for v in (a, b))
    assert names.assign(x, y) is not None and names.assign(y, x) is not None


@pytest.mark.parametrize("a, b", [("Gerard", "Everard"), ("Otto", "Joël"), ("J.", "Pieter"), ("Theodorus Ulrich", "Theodorus Pieter"), ("Daniël", "Michaël"), ("Frederik", "Diederik"), ("Leonard", "Eléonore"), ("Philippus", "Coenraad Philippus"), ("J.", "Rafaël Jérôme")])
def test_given_names_that_do_not_fit(a, b):
    x, y = (tuple(names.parts("Berg", v, None, False)[1]) for v in (a, b))
    assert names.assign(x, y) is None


def test_people_bodies_generations_and_relatives(spark):
    rows = [
        entry(1, "Merkanaarän", "Elisabeth Balthasar"), entry(2, "MERKANAARAEN", "Betje B.", 1652, 1659), entry(3, "Merka-Naarän", "Elisabeth", 1651, None), entry(4, "Merkanaran", "Elisabeth Balthasar", None, 1661, corpus="bl"),
        entry(5, "Merkanaarän", "Elisabeth Balthasar", 1750, 1760), entry(6, "Merkanaarän", "Otto"), entry(7, "Merkanaarän", "Elisabeth", kind="consul"), entry(8, "Merkanaarän", "Elisabeth", post="heer van X"), entry(9, "Merkanaarän", "Elisabeth", kind="college"),
        entry(10, "Raad van Brélkunijgrieft", None, kind="college"), entry(11, "Brelkunygrieft, Raad v.", None, kind="college"), entry(12, "Raad van Dielkeeleugrieft", None, kind="college"),
        entry(20, None, None, title="Tolkeezuun, Simon van"), entry(21, "Tolkeezuun", "Sim."), entry(30, None, None), entry(31, "", ""), (32, None, None, None, None, None, None, None, None, None),
    ]
    rows += rows[:2]
    own = [1, 2, 3, 4, 7, 8]
    assert pairs(spark, rows) == [*((a, b) for a in own for b in own if a < b), (10, 11), (20, 21)]


def test_many_copies_and_empty_table(spark):
    rows = [entry(i, "Hardewijk", "Otto") for i in range(40)]
    assert len(pairs(spark, rows)) == 40 * 39 // 2
    assert pairs(spark, []) == []


def test_components_follow_long_chains(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 30)] + [(100, 101), (101, 102)], "a bigint, b bigint")
    got = {r.id: r.root for r in names.components(links).collect()}
    assert got == {**dict.fromkeys(range(1, 31), 1), 100: 100, 101: 100, 102: 100}


def test_exchanged_name_parts(spark):
    rows = [
        # the given name in the place of the surname, twice, once short; all with their own group
        entry(1, "Nölfareugroom", "Michaël"), entry(2, "Michaël", "Nölfareugroom"), entry(3, "Mich.", "van Nölfareugrom"), entry(4, "Nölfareugroom", "M."),
        # both exchanged, with no entry in the usual order
        entry(10, "Wilhelmus", "Voengipaasteenk"), entry(11, "Wm.", "Voengipaasteenk"),
        # given names on both sides, and a name that holds both
        entry(20, "Simon", "Pieter", 1550, 1560), entry(21, "Pieter", "Simon", 1550, 1560), entry(22, "Otto Hardewijk", None), entry(23, "Hardewijk", "Otto"),
        entry(24, None, None, title="Otto, Hardewijk"),
        # relatives, namesakes and a bare surname that is the given name of others
        entry(30, "Otto", "Nölfareugroom"), entry(31, "Michaël", "Nölfareugroom", 1750, 1760), entry(32, "Gustaaf", None), entry(33, "Merkanaran", "Gustaaf"), entry(34, "Dielkeeleugrieft", "Gustaaf"),
    ]
    assert pairs(spark, rows) == [(1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (3, 4), (10, 11), (20, 21), (22, 23), (22, 24), (23, 24)]


def test_cheapest_assignment_against_all_orders():
    from itertools import permutations

    rng = random.Random(3)
    for _ in range(400):
        n, m = sorted(rng.randrange(1, 6) for _ in range(2))
        costs = [[rng.choice([None, 0, 1, 2]) for _ in range(m)] for _ in range(n)]
        sums = [sum(costs[k][c] for k, c in enumerate(p)) for p in permutations(range(m), n) if all(costs[k][c] is not None for k, c in enumerate(p))]
        assert names._cheapest(costs) == min(sums, default=None)


def test_many_tokens_are_assigned_exactly():
    rest = [f"naam{c * 4}" for c in "abdfghjklmnp"]
    # the initial must leave the only other fit to the longer abbreviation
    short, long = (*rest, "p.", "pie."), (*rest, "pieter", "paulus")
    assert names.assign(short, long, False) is not None


def test_bodies_of_short_and_generic_words(spark):
    rows = [entry(i, name, None, kind="college") for i, name in enumerate(["Raad van Goa", "Raad van Goa", "Goa, Raad v.", "Raad van Ede", "Kamer van Koophandel", "Kamer v. Koophandle", "Directie"], 1)]
    assert pairs(spark, rows) == [(1, 2), (1, 3), (2, 3), (5, 6)]


def test_tokens_that_fit_meet_in_a_form():
    rng = random.Random(5)
    given = sorted({v for k, vs in names.SHORT_FORMS.items() for v in (k, *vs.split())} | {"ariaantje", "wendelmoed", "ysbrandt", "quirijn"})

    def spoil(w):
        i = rng.randrange(len(w))
        return rng.choice([w, w, w[0] + ".", w[: rng.randrange(1, len(w) + 1)] + ".", w[:i] + w[i + 1 :], w[:i] + rng.choice("aeknz") + w[i:], w[:i] + w[i : i + 2][::-1] + w[i + 2 :]])

    tokens = [t for t in (spoil(rng.choice(given)) for _ in range(500)) if t.strip(".")]
    fit = 0
    for x in tokens:
        for y in rng.sample(tokens, 60):
            if names.token_cost(x, y) is not None:
                fit += 1
                (seek_x, found_x), (seek_y, found_y) = names.meetings(x), names.meetings(y)
                assert set(seek_x) & set(found_y) or set(seek_y) & set(found_x), (x, y)
    assert fit > 300
