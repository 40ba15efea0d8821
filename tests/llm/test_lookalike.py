import math
from collections import Counter

from colophon.llm import garbled, lookalike, shapes

CLEAN = ["Hendrik van den Berg schreef een brief", "de Staten van Holland", "het woord градъ", "λόγος τοῦ θεωροῦ", "40 m² en 12½ ¹", "Thérèse Löwe — „zo”", "één keer"]


def bigrams(texts=CLEAN * 20):
    import pyarrow as pa

    counts, firsts = Counter(), Counter()
    lookalike.Letters(("t",))(pa.RecordBatch.from_arrays([pa.array(texts)], names=["t"]), counts)
    for (*_, a, _), n in counts.items():
        firsts[a] += n
    return {(a, b): math.log(n / firsts[a]) for (*_, a, b), n in counts.items()}


CASES = {
    "Ｈｅｎｄｒｉｋ": "Hendrik", "Нendrіk": "Hendrik", "Löwe": "Löwe", "a​b": "ab", "van den": "van den", "van den": "van den", "van　den": "van den", "ｔｅ １６９９": "te 1699", "οp de brιef": "op de brief", "Be﻿rg": "Berg", "Ꮋendrik": "Hendrik", "schօol": "school",
}


def test_each_form_is_found_and_undone():
    b = bigrams()
    for bad, good in CASES.items():
        assert lookalike.disguised(bad, garbled.NOTHING, b), bad
        assert lookalike.unify(bad, b)[0] == good, bad


def test_honest_text_is_no_case():
    b = bigrams()
    for t in [*CLEAN, None, "", "ascii", "градъ", "ÂRD", "f 12½", "½¾²§«»„“"]:
        assert not lookalike.disguised(t, garbled.NOTHING, b), t
        if t:
            assert lookalike.unify(t, b)[0] == t


def test_products_of_wrong_decoding_are_no_case():
    mapping = lookalike.spaced(garbled.Mapping({"Ã©": "é", "Â\xa0": "\xa0"}))
    assert not lookalike.disguised("RenÃ©", mapping, bigrams())
    assert not lookalike.disguised("vanÂ\xa0den", mapping, bigrams())
    assert lookalike.disguised("Th​RenÃ©", mapping, bigrams())
    assert lookalike.disguised("Ã﻿©", mapping, bigrams())


def test_distribution(spark):
    rows = [(i, "nl", t, None) for i, t in enumerate(CLEAN * 5)] + [(90, "nl", "Нendrіk", "ｔｅ"), (90, "nl", "Нendrіk", "ｔｅ"), (91, None, None, "")]
    df = spark.createDataFrame(rows, "lemma_id bigint, corpus string, text string, toc_title string")
    assert sorted(tuple(r) for r in lookalike.disguised_values(df).collect()) == [(90, "text"), (90, "toc_title")]
    assert {r.lemma_id: r.text for r in lookalike.unified_values(df).collect()}[90] == "Hendrik"
    assert lookalike.disguised_values(df.limit(0)).count() == 0


def test_tables_do_not_clash():
    tables = (shapes.CYRILLIC, shapes.GREEK, shapes.ARMENIAN, shapes.CHEROKEE)
    assert len(shapes.LOOKS) == sum(map(len, tables)) and all(lookalike.script(c) not in ("", "L") for c in shapes.LOOKS)
    assert all(v.isascii() for v in shapes.LOOKS.values())
    assert garbled.ZERO_WIDTH and all(len(c) == 1 for c in garbled.ZERO_WIDTH)


def test_every_blank_becomes_a_space():
    for c in "\u2000\u2003\u2009\u200a\u205f\u1680":
        assert lookalike.unify(f"van{c}den", bigrams())[0] == "van den" and not lookalike.disguised(f"van{c}den", garbled.NOTHING, bigrams())
