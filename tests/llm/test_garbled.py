from collections import Counter

import pandas as pd
import pyarrow as pa
import pytest

from colophon.llm import garbled

CLEAN = ["Günther von Müller is één van de coördinatie", "Thérèse Løvenskjold, zaakgelastigde", "ƒ 300, zegge drie", "ÂRD en SÃO in kapitalen", "het woord градъ", "λόγος τοῦ θεωροῦ", "É¬\nén te Élgensund, zee¬\nzaken", "f 12½ en 3¾ — § 4"] * 30


def damage(text, page, times=1):
    for _ in range(times):
        raw = text.encode("utf-8")
        table = {}
        for b in range(256):
            try:
                table[b] = bytes([b]).decode(page)
            except UnicodeDecodeError:
                table[b] = chr(b)
        text = "".join(table[b] for b in raw)
    return text


def learn(texts, others=()):
    """The mapping of the source ``s``; the other texts are of another source."""
    batch = pa.RecordBatch.from_arrays([pa.array(["s"] * len(texts) + ["o"] * len(others)), pa.array([*texts, *others])], names=["source", "text"])
    counts = Counter()
    garbled.Evidence("source", ("text",))(batch, counts)
    rows = pd.DataFrame([(*k, n) for k, n in counts.items()], columns=["kind", "source", "a", "b", "c", "n"])
    plain = rows[rows["kind"] == "b"].groupby(["b", "c"])["n"].sum().to_dict()
    made = garbled._learn_source(plain)(("s",), rows[rows["source"] == "s"])
    return garbled.Mapping(dict(zip(made["symbol"], made["letters"])))


WESTERN = ["latin-1", "cp1252", "cp1250", "cp437", "cp850", "mac_roman"]


@pytest.mark.parametrize("page", [*WESTERN, "cp1251", "cp1253", "koi8_r", "cp866", "mac_greek", "iso8859_5"])
@pytest.mark.parametrize("times", [1, 2, 3, 6])
def test_wrong_pages_are_undone(page, times):
    broken = [damage(t, page, times) for t in CLEAN[:6]]
    mapping = learn(CLEAN + broken)
    for bad, good in zip(broken, CLEAN):
        restored, n = garbled.repair(bad, mapping)
        assert restored == good and (n > 0) == (bad != good)


def test_honest_text_is_left_alone():
    mapping = learn(CLEAN + [damage(CLEAN[0], "cp1252")])
    for good in CLEAN:
        assert garbled.repair(good, mapping) == (good, 0)


def test_zero_width_inside_a_unit():
    mapping = learn(CLEAN + [damage(CLEAN[1], "cp1252")])
    assert garbled.repair("ThÃ﻿©rÃ¨se", mapping)[0] == "Thérèse"


def test_distribution_nulls_and_redeliveries(spark):
    rows = [(i, "nl" if i % 2 else None, t, None, None) for i, t in enumerate(CLEAN[:8])]
    rows += [(100, "nl", damage("Günther", "cp1252"), "Ren�", "ok"), (100, "nl", damage("Günther", "cp1252"), "Ren�", "ok"), (101, None, None, "", "ï")]
    df = spark.createDataFrame(rows, "lemma_id bigint, corpus string, text string, name string, givenname string").selectExpr("*", "name as field_name", "1 as id")
    assert sorted(tuple(r) for r in garbled.garbled_values(df).collect()) == [(100, "name"), (100, "text")]
    back = {r.lemma_id: r for r in garbled.restored_values(df).collect()}
    assert back[100].text == "Günther" and back[101].text is None and len(back) == 10
    assert garbled.garbled_values(df.limit(0)).count() == 0


@pytest.mark.parametrize("written, read", [("cp850", "cp1252"), ("mac_roman", "cp1252"), ("cp437", "latin_1"), ("cp1252", "cp850"), ("cp1252", "cp1251"), ("hp_roman8", "cp1252")])
def test_single_byte_swaps_are_undone(written, read):
    clean = ["Günther en Thérèse te Köln, één van de coördinatoren", "de financiële crisis en het café", "Réaumur, geïnstrueerd, België, geëerd"] * 30
    known = dict(zip(bytes(range(128, 256)).decode(written, "replace"), (bytes([b]).decode(read, "ignore") or chr(b) for b in range(128, 256))))
    swap = lambda t: "".join(known.get(c, c) for c in t)
    mapping = learn([swap(t) for t in clean], clean)
    for t in clean[:3]:
        assert garbled.repair(swap(t), mapping) == (t, sum(c >= "\x80" for c in t))
    # the other source, and what is not between letters, stays
    assert not learn(clean, clean)
    assert garbled.repair("nr. ‚ 12 ‰", mapping)[1] == 0


def test_lookalikes_and_slips_are_no_swaps():
    clean = ["de later gezant in het land", "gulden en brieven zonder één fout"] * 30
    broken = [t.replace("t", "†").replace("e", "е").replace("a", "ａ") for t in clean]
    assert not learn(broken, clean)


def test_long_runs_are_letter_by_letter():
    for n in (1, 30, 70, 3000):
        assert [u[2] for u in garbled.units("Ã©" * n)] == ["Ã©"] * n
        assert garbled.repair("a" + "Ã©" * n, garbled.Mapping({"Ã©": "é"})) == ("a" + "é" * n, n)


def test_candidates_are_never_controls():
    assert all(not any(ord(c) < 32 or 127 <= ord(c) < 160 for c in x) for u in ("Ã\x83", "Â\x80", "ÃƒÂƒÃ‚Â©") for x in garbled.candidates(u))
    assert Counter(garbled.candidates("Ã©"))["é"] == 1
