"""One form for text that looks the same (problem 3).

A value is first freed of what wrong decoding left (that is another problem's).  Then full-width forms fold to their plain ones,
accents that stand alone join their letter, ignorable characters go, and spaces that only look like a space become one.  Raised
figures, fractions, signs and quotation marks keep their form.  A word that mixes scripts is a lattice: each character stands for itself
or for the letter of the other script it looks like.  Viterbi finds the path with the best score under letter bigrams counted per
script over the corpus, a change of script inside a word being dear.  Words wholly in one script are left alone.

Defined results: null and ASCII values have one form already; a repeated delivery counts once.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colophon.llm import counting, garbled
from colophon.llm.shapes import LOOKS
from colophon.session import cut

FIELDS = ("text", "toc_title")
ZERO_WIDTH = "​‌‍⁠﻿᠎­"

_WIDE = re.compile("[！-｠￠-￦　]")
_MARK = re.compile("[̀-ͯ᪰-᫿᷀-᷿]")
_ZERO = re.compile(f"[{ZERO_WIDTH}]")
HARD = re.compile("[   ]")
_WORD = re.compile(r"[^\W\d_]+(?:[̀-ͯ][^\W\d_]*)*")
# every blank of one line becomes a plain space, though only the hard ones are a disguise
_BLANKS = re.compile(f"[{''.join(c for c in map(chr, range(0x80, 0x3001)) if unicodedata.category(c) == 'Zs')}]")
# letters of the other scripts
_OTHER = re.compile("[\u0370-\u058f\u13a0-\u13ff\u1f00-\u1fff]")
_FLOOR = math.log(1e-6)
_SWITCH = math.log(1e-9)


def script(c: str) -> str:
    """L, C, G, A or K for a Latin, Cyrillic, Greek, Armenian or Cherokee letter, else nothing."""
    o = ord(c)
    if o < 0x250:
        return "L" if c.isalpha() and c not in "ªºµ" else ""
    if 0x370 <= o < 0x400 or 0x1F00 <= o < 0x2000:
        return "G"
    if 0x400 <= o < 0x530:
        return "C"
    if 0x530 <= o < 0x590:
        return "A"
    if 0x13A0 <= o < 0x1400:
        return "K"
    return "L" if 0x1E00 <= o < 0x1F00 else ""


def fold(text: str) -> str:
    """Compatibility forms, accents and ignorable characters, without the look-alikes."""
    if text.isascii():
        return text
    text = _WIDE.sub(lambda m: unicodedata.normalize("NFKC", m.group()), text)
    text = _ZERO.sub("", text)
    return unicodedata.normalize("NFC", _BLANKS.sub(" ", text))


def mixed(word: str) -> bool:
    scripts = {script(c) for c in word} - {""}
    return "L" in scripts and len(scripts) > 1


def viterbi(word: str, bigrams: dict[tuple[str, str], float]) -> str:
    """The best path through the lattice of a word: itself or its look-alike at each place."""
    options = [(c, LOOKS[c]) if c in LOOKS else (c,) for c in word]
    best = {o: (bigrams.get((" ", o), _FLOOR), o) for o in options[0]}
    for choice in options[1:]:
        best = {
            o: max((score + bigrams.get((p, o), _FLOOR) + (_SWITCH if script(p) and script(o) and script(p) != script(o) else 0.0), path + o) for p, (score, path) in best.items())
            for o in choice
        }
    return max((score + bigrams.get((o, " "), _FLOOR), path) for o, (score, path) in best.items())[1]


def unify(text: str, bigrams: dict[tuple[str, str], float]) -> tuple[str, bool]:
    """The one form of a text freed of garbled symbols, and whether a look-alike was replaced."""
    folded, hit = fold(text), False
    if not _OTHER.search(folded):
        return folded, False

    def word(m: re.Match) -> str:
        nonlocal hit
        w = m.group()
        if w.isascii() or not mixed(w):
            return w
        best = viterbi(w, bigrams)
        hit |= best != w
        return best

    return _WORD.sub(word, folded), hit


def spaced(mapping: garbled.Mapping) -> garbled.Mapping:
    """The mapping with hard spaces as plain ones: those that wrong decoding left are no disguise."""
    return garbled.Mapping({k: " " if HARD.search(v) else v for k, v in mapping.items()})


def disguised(text: str | None, mapping: garbled.Mapping, bigrams: dict[tuple[str, str], float]) -> bool:
    """Whether a value holds one of the forms above; ``mapping`` is ``spaced``.

    No code page has full-width forms, combining accents or zero-width characters, so these are never products of wrong decoding; a hard space or
    a foreign letter may be, and is looked for in what is left once such symbols are restored.
    """
    if not text or text.isascii():
        return False
    if _WIDE.search(text) or _MARK.search(text) or _ZERO.search(text):
        return True
    plain = garbled.substitute(text, mapping)[0] if mapping else text
    return bool(HARD.search(plain)) or unify(plain, bigrams)[1]


class Letters:
    """Counts letter bigrams (``l``) of the words that are wholly in one script, a space standing for the ends of a word."""

    def __init__(self, fields: tuple[str, ...]) -> None:
        self.fields = fields

    def __call__(self, batch: pa.RecordBatch, counts: Counter) -> None:
        words: Counter = Counter()
        for field in self.fields:
            for text in batch.column(field).to_pylist():
                if text:
                    words.update(text.split())
        pairs: Counter = Counter()
        for word, n in words.items():
            for w in _WORD.findall(word):
                if not mixed(w):
                    for pair in zip(" " + w, w + " "):
                        pairs[pair] += n
        for (a, b), n in pairs.items():
            counts["l", None, None, a, b] += n


def letter_bigrams(counts: DataFrame) -> dict[tuple[str, str], float]:
    """Log probabilities of letter after letter, from what ``Letters`` counted."""
    known = counting.pairs(counts, "l")
    firsts: Counter = Counter()
    for (a, _), n in known.items():
        firsts[a] += n
    return {(a, b): math.log(n / firsts[a]) for (a, b), n in known.items()}


def learned(rows: DataFrame, source: str, garbled_fields: tuple[str, ...], letter_fields: tuple[str, ...]) -> tuple[dict[str | None, garbled.Mapping], dict[tuple[str, str], float]]:
    """The mappings of wrong decoding and the letter bigrams of a table, counted in one pass."""
    picked = rows.select(F.col(source).cast("string").alias("source"), *dict.fromkeys([*garbled_fields, *letter_fields]))
    counts = cut(counting.counted(picked, [garbled.Evidence("source", garbled_fields), Letters(letter_fields)]))
    return garbled.mappings(counts), letter_bigrams(counts)


def _judge(it: Iterator[pa.RecordBatch], maps: dict, bigrams: dict, fields: tuple[str, ...], restore: bool) -> Iterator[pa.RecordBatch]:
    maps = maps if restore else {s: spaced(m) for s, m in maps.items()}
    for batch in it:
        ids, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        if restore:
            done = [[v if v is None or v.isascii() else unify(garbled.repair(v, maps.get(s, garbled.NOTHING))[0], bigrams)[0] for s, v in zip(sources, c.to_pylist())] for c in batch.columns[2:]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, type=pa.string()) for c in done)], names=["id", *fields])
            continue
        out = [(i, f) for f, c in zip(fields, batch.columns[2:]) for i, s, v in zip(ids, sources, c.to_pylist()) if disguised(v, maps.get(s, garbled.NOTHING), bigrams)]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], type=pa.int64()), pa.array([r[1] for r in out], type=pa.string())], names=["id", "field_name"])


def disguised_values(rows: DataFrame, key: str = "lemma_id", source: str = "corpus", fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Key and field of every value that a form above disguises."""
    maps, bigrams = learned(rows, source, fields, fields)
    found = garbled.picked(rows, key, source, fields).mapInArrow(lambda it: _judge(it, maps, bigrams, fields, False), "id bigint, field_name string")
    return found.dropDuplicates(["id", "field_name"]).withColumnRenamed("id", key)


def unified_values(rows: DataFrame, key: str = "lemma_id", source: str = "corpus", fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Every record once, with its fields in one form."""
    maps, bigrams = learned(rows, source, fields, fields)
    ddl = "id bigint, " + ", ".join(f"`{f}` string" for f in fields)
    return garbled.picked(rows, key, source, fields).mapInArrow(lambda it: _judge(it, maps, bigrams, fields, True), ddl).dropDuplicates(["id"]).withColumnRenamed("id", key)
