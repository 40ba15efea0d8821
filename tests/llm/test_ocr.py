import random
from functools import lru_cache

import pytest

from colophon.llm import ocr

WORDS = dict.fromkeys("gulden zonder brief later kinderen opgevolgd vergoeding verblijfkosten zeezaken minister vice-consul resident aanstelling geïnstrueerd bereikte".split(), 100)
CHAPTERS = {"IV. Pomkovië", "VI. Galdaland", "X. Läpvenië"}


@pytest.fixture(scope="module")
def reader():
    return ocr.Reader(WORDS, CHAPTERS, {"in", "land", "reis"})


def kinds(reader, lines, page=12):
    return sorted(set(ocr.noise(reader, lines, page)))


def test_furniture(reader):
    heads = ["POMKOVIË", "12     POMKOVIË", "P0MKOV1Ë   12", ". GALDALAND .  12", "G A L D A L A N D", "Pomkovië 13", "LÄPVENIÉ   12"]
    numbers = ["12", "- 12 -", "— 13", "[12]", "12.", "1 2", "l2"]
    assert kinds(reader, heads) == [(i, "header") for i in range(len(heads))]
    assert kinds(reader, numbers) == [(i, "page_number") for i in range(len(numbers))]
    honest = ["in 1653.", "nr. 166.", "771v.", "1653.", "Pomkovië verklaarde de oorlog aan Galdaland", "999", "op.", ""]
    assert kinds(reader, honest) == []


def test_hyphens(reader):
    assert kinds(reader, ["werd opge-", "volgd door"]) == [(0, "hyphen")]
    assert kinds(reader, ["werd opge¬", "12", "POMKOVIË", "", "volgd door"]) == [(0, "hyphen"), (1, "page_number"), (2, "header")]
    assert kinds(reader, ["werd opge- ", "volgd"]) == [(0, "hyphen")]
    assert kinds(reader, ["de vice-", "consul"]) == [(0, "hyphen")]
    for honest in (["land-", "en zeezaken"], ["reis-", "12", "en verblijfkosten"], ["opge-"], ["—", "x"], ["Jan -", "x"], ["opge-", "Volgens"], ["1653-", "1655"]):
        assert not any(k == "hyphen" for _, k in ocr.noise(reader, honest, 12)), honest


def test_misread_words_and_years(reader):
    for bad in ("guldcn", "gu1den", "9ulden", "gulclen", "gulderi", "giilden", "zorider", "kmderen", "la†er", "br!ef", "rninister", "aansteUing", "9e�nstrueerd", "l644", "1?05", "16A6", "I703,", "17b1"):
        assert kinds(reader, [f"de {bad} van"]) == [(0, "misread")], bad
    for honest in ("gulden", "Guldcn", "1644", "771v", "12½", "8250", "Marnöwijk", "ge�nstrueerd", "latin", "19a", "brief!", "1644?"):
        assert kinds(reader, [f"de {honest} van"]) == [], honest


def test_place_of_a_misread_joined_word(reader):
    assert kinds(reader, ["de vcrgoe-", "ding"]) == [(0, "hyphen"), (0, "misread")]
    assert kinds(reader, ["de vergoe-", "12", "d!ng"]) == [(0, "hyphen"), (1, "page_number"), (2, "misread")]


def test_paragraphs(reader):
    lines = ["Hij werd opge-", "12  POMKOVIË", "volgd met 100 guldcn in", "l644.", "Reis-", "en verblijfkosten"]
    assert ocr.paragraphs(reader, lines, 12, {4}) == ["Hij werd opgevolgd met 100 gulden in 1644.", "Reis- en verblijfkosten"]
    assert ocr.paragraphs(reader, [], None, set()) == []


def test_confusions_are_cheap():
    trie = ocr.Trie(WORDS)
    for word in WORDS:
        for read, printed in ocr.CONFUSIONS:
            at = word.find(printed)
            if at >= 0:
                once = word[:at] + read + word[at + len(printed) :]
                assert (ocr.SHAPE, word) in trie.within(once, 2 * ocr.SHAPE, False) or once == word, once
    assert trie.within("") == [] and trie.within("q" * 5000) == []


def test_other_edits_find_their_word():
    trie = ocr.Trie(["minister", "koning", "resident"])
    for bad, good in {"mimister": "minister", "minlster": "minister", "ministre": "minister", "mnister": "minister", "miinister": "minister", "kuning": "koning", "konlng": "koning"}.items():
        assert [w for _, w in trie.within(bad, ocr.OTHER)] == [good], bad
    assert trie.within("kuninc", ocr.OTHER) == [] and trie.within("kuninc", 2 * ocr.OTHER) == [(2 * ocr.OTHER, "koning")]


def test_the_automaton_finds_every_word_within_the_bound():
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("abcdm") for _ in range(rng.randrange(1, 7))) for _ in range(120)})
    trie = ocr.Trie(words)

    @lru_cache(None)
    def plain(a, b):
        if not a or not b:
            return len(a) + len(b)
        best = min(plain(a[1:], b) + 1, plain(a, b[1:]) + 1, plain(a[1:], b[1:]) + (a[0] != b[0]))
        return min(best, plain(a[2:], b[2:]) + 1) if a[:2] == b[:2][::-1] and len(a) > 1 and len(b) > 1 else best

    @lru_cache(None)
    def shaped(a, b):
        """Least cost of an alignment, by recursion over both ends."""
        if not a and not b:
            return 0
        out = [99]
        if a and b:
            out.append(shaped(a[1:], b[1:]) + (0 if a[0] == b[0] else ocr.OTHER))
        if a:
            out.append(shaped(a[1:], b) + ocr.OTHER)
        if b:
            out.append(shaped(a, b[1:]) + ocr.OTHER)
        if len(a) > 1 and len(b) > 1 and a[0] == b[1] != a[1] == b[0]:
            out.append(shaped(a[2:], b[2:]) + ocr.OTHER)
        out += [shaped(a[len(r) :], b[len(p) :]) + ocr.SHAPE for r, p in ocr.CONFUSIONS if a.startswith(r) and b.startswith(p)]
        return min(out)

    for _ in range(250):
        token = "".join(rng.choice("abcdm16lr") for _ in range(rng.randrange(0, 7)))
        for most in (0, 2, 3, 4, 6):
            assert trie.within(token, most) == sorted((shaped(token, w), w) for w in words if shaped(token, w) <= most)
        if not set(token) & set("16lrcm"):
            assert {w for _, w in trie.within(token, ocr.OTHER)} == {w for w in words if plain(token, w) <= 1}


def test_other_edits_need_small_letters_and_context():
    reader = ocr.Reader(WORDS, CHAPTERS, set(), {("de", "minister"): 40, ("een", "gulden"): 40})
    for bad in ("ministre", "mnister", "mimister"):
        assert kinds(reader, [f"de {bad} van"]) == [(0, "misread")], bad
        assert kinds(reader, [f"te {bad} van"]) == [] and kinds(reader, [f"de {bad.title()} van"]) == []
    assert ocr.paragraphs(reader, ["de ministre", "een guldem"], 12, set()) == ["de minister een gulden"]


def test_short_words_may_hold_one_error():
    reader = ocr.Reader({**WORDS, "met": 900, "door": 400, "van": 900}, CHAPTERS, set())
    assert kinds(reader, ["mct d0or vari"]) == [(0, "misread")]
    assert ocr.paragraphs(reader, ["mct d0or vari", "rnct"], 12, set()) == ["met door van rnct"]


def test_rare_misreadings_stay_out_of_the_vocabulary():
    assert ocr.vocabulary({"gulden": 800, "guldcn": 30, "later": 90, "latcr": 30, "hecht": 5, "heeht": 5}) == {"gulden": 800, "later": 90, "latcr": 30, "hecht": 5, "heeht": 5}


def test_a_page_number_can_be_reached():
    reader = ocr.Reader(WORDS, CHAPTERS, set())
    many = ["een brief"] * 30
    assert kinds(reader, ["12", "brief", "14", *many, "40", "11", "90"]) == [(0, "page_number"), (2, "page_number"), (33, "page_number")]
    assert kinds(reader, ["1234", "12345"], None) == [(0, "page_number")]


def test_distribution(spark):
    line = lambda seq, t, zone="body": (zone, t, 3, seq)
    body = "hij werd resident zonder gulden later"
    rows = [(i, "nl", "IV. Pomkovië", 12, [line(1, body), line(2, body)], {"1": body}, body) for i in range(60)]
    noisy = (900, "nl", None, None, [line(2, "dent in 1650"), line(1, "de resi-"), None], {"7": "zondcr\nPOMKOVIË"}, "gulclen\n12 POMKOVIË\nen")
    rows += [noisy, noisy, (901, None, None, None, None, None, None), (902, None, None, None, [], {}, "")]
    schema = "lemma_id bigint, corpus string, toc_chapter string, toc_page int, lines array<struct<zone string, text string, indent int, seq int>>, footnotes map<string,string>, text string"
    df = spark.createDataFrame(rows, schema).selectExpr("*", "'x' as kind", "1 as item_key")
    got = sorted(tuple(r) for r in ocr.scan_noise(df).collect())
    assert got == [(900, "footnotes", "7", "header"), (900, "footnotes", "7", "misread"), (900, "lines", "1", "hyphen"), (900, "text", "1", "misread"), (900, "text", "2", "header")]
    clean = {(r.lemma_id, r.field_name): r.clean for r in ocr.clean_paragraphs(df).collect()}
    assert clean[900, "lines"] == "de resident in 1650" and clean[900, "text"] == "gulden en" and clean[900, "footnotes"] == "zonder"
    assert ocr.scan_noise(df.limit(0)).count() == 0
