"""Garbled text from wrong decoding (problem 2).

Which code page a text was written in, which one it was read with, and how often, is not known; so what is left of it is read as a
substitution cipher, source by source.  There are two sorts of cipher symbols:

* *Units* come from UTF-8 bytes that were read with a single-byte page: a character that stands for a lead byte and one to three
  that stand for continuation bytes, by any page Python knows.  Units that touch form a run, which is cut into the pieces that each
  were one letter, however many times it was decoded.  Candidates of a piece are what any pages make of it, and itself, as a
  unit may also be two honest characters.
* *Single symbols* come from one single-byte page read as another one: a character outside ASCII beside a letter that the other
  sources do not use in such places.  Candidates are the letters of the language that any two pages make of it, and itself; the pages are
  hidden and shared by the symbols of a source.  Pages agree in ASCII, so a lone odd character (a look-alike, a slip of scanning) stays.

Per source, expectation-maximisation weighs the candidates by the bigrams of the language around each occurrence; the bigrams are counted over
the text outside of units, for single symbols over the other sources.  The learned mapping is applied with ``translate`` (symbols
become private characters first).

Counting bigrams and contexts is distributed, and so is learning: each source learns in its own task from its counts, whose
number is bounded by the characters in use and not by the rows.

Defined results: null and plain ASCII values are never garbled; U+FFFD marks a lost character and makes the value a case (``lost`` fills in
what the corpus still knows); single symbols need a second source to be told from honest ones; a repeated delivery counts once.
"""

from __future__ import annotations

import importlib
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from encodings.aliases import aliases

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colophon.llm import counting
from colophon.llm.shapes import LOOKS
from colophon.session import cut

FIELDS = ("text", "name", "givenname")
LOST = "�"
ZERO_WIDTH = "​‌‍⁠﻿"
_FLOOR = 1e-7
# a letter of the language makes up this part of its text; a single symbol stands for one if it has been seen so often, so many of its places become bigrams
# of the language, and so many symbols agree on the pages
LETTER_SHARE, SEEN, FIT, AGREED = 1e-5, 3, 0.5, 2
# pages tried first; the order decides nothing but which of equal readings cuts a run
_FIRST = ("cp1252", "latin_1")


def _byte_tables() -> list[dict[str, int]]:
    """Character to byte of every single-byte page that agrees with ASCII; bytes a page leaves open are the control characters of the same number."""
    tables: list[dict[str, int]] = []
    for page in (*_FIRST, *sorted(set(aliases.values()) - set(_FIRST))):
        try:
            known = getattr(importlib.import_module(f"encodings.{page}"), "decoding_table", None)
        except ImportError:
            continue
        if page == "latin_1":
            known = "".join(map(chr, range(256)))
        if known is None or known[:128] != "".join(map(chr, range(128))):
            continue
        table = {c: b for b, c in enumerate(known) if b >= 0x80 and c != "￾"}
        for b in range(0x80, 0xA0):
            if b >= len(known) or known[b] == "￾":
                table.setdefault(chr(b), b)
        if table not in tables:
            tables.append(table)
    return tables


TABLES = _byte_tables()
_CHARACTERS = [{b: c for c, b in t.items()} for t in TABLES]
_LEADS: dict[str, list[int]] = {}
for _k, _t in enumerate(TABLES):
    for _c, _b in _t.items():
        if 0xC2 <= _b <= 0xF4:
            _LEADS.setdefault(_c, []).append(_k)
_IN_PAGES = frozenset(c for t in TABLES for c in t)
_RUN = re.compile(f"[{re.escape(''.join(sorted(_IN_PAGES)))}{ZERO_WIDTH}]{{2,}}")
_HIGH = re.compile("[^\x00-\x7f]")
# lead characters whose accent was split off later
_SPLIT = re.compile("[AaEeUuOo][̀-̊]")


def composed(text: str) -> str:
    """The text with split accents joined again, so that units show."""
    return _SPLIT.sub(lambda m: unicodedata.normalize("NFC", m.group()), text)


def _readings(chars: str, pages: frozenset[int] | None = None) -> Iterator[str]:
    """What one wrong decoding may have stood for, by page after page (all, or those of ``pages``)."""
    first = next((c for c in chars if c >= "\x80"), "")
    for k in _LEADS.get(first, ()):
        if pages is None or k in pages:
            table = TABLES[k]
            try:
                yield bytes([table[c] if c >= "\x80" else ord(c) for c in chars]).decode("utf-8")
            except (KeyError, UnicodeDecodeError):
                pass


def candidates(symbol: str, pages: frozenset[int] | None = None) -> set[str]:
    """What a symbol may have been before it was decoded wrongly, any number of times; no controls and no private characters.

    Every decoding shortens the symbol, so there is an end.
    """
    seen: set[str] = set()
    fresh = {symbol}
    while fresh:
        fresh = {y for x in fresh if not x.isascii() for y in _readings(x, pages)} - seen - {symbol}
        seen |= fresh
    return {x for x in seen if not any(unicodedata.category(c) in ("Cc", "Cn", "Co", "Cs") for c in x)}


class _Memo(dict):
    """Results met before; emptied when it is full."""

    def __init__(self, compute) -> None:
        super().__init__()
        self.compute = compute

    def __missing__(self, key: str):
        out = self.compute(key)
        if len(key) <= 256:
            if len(self) >= 100_000:
                self.clear()
            self[key] = out
        return out


def _under(run: str, table: dict[str, int]) -> list[tuple[int, int, str]]:
    """Start, end and letter of the units of a run by one page."""
    out, at = [], 0
    codes = [table.get(c, 0) for c in run]
    while at < len(run):
        b = codes[at]
        n = 2 if 0xC2 <= b <= 0xDF else 3 if 0xE0 <= b <= 0xEF else 4 if 0xF0 <= b <= 0xF4 else 1
        if n > 1 and len(part := codes[at : at + n]) == n:
            try:
                out.append((at, at + n, bytes(part).decode("utf-8")))
            except UnicodeDecodeError:
                n = 1
        at += n
    return out


def _parse(run: str) -> tuple[tuple[int, int], ...]:
    """Where the symbols of a run stand that each were one letter, by the page that explains most of the run; letters that form a
    run with units themselves are taken together, however often the text was decoded."""
    best: list[tuple[int, int, str]] = []
    covered = 0
    for k in sorted({k for c in set(run) for k in _LEADS.get(c, ())}):
        found = _under(run, TABLES[k])
        if (cover := sum(b - a for a, b, _ in found)) > covered:
            best, covered = found, cover
    out: list[tuple[int, int]] = []
    first = 0
    while first < len(best):
        last = first
        while last + 1 < len(best) and best[last + 1][0] == best[last][1]:
            last += 1
        text = "".join(x[2] for x in best[first : last + 1])
        inner = {m.start() + a: m.start() + b for m in _RUN.finditer(text) for a, b in _SYMBOLS[m.group()]}
        k = 0
        while k < len(text):
            end = inner.get(k, k + 1)
            out.append((best[first + k][0], best[first + end - 1][1]))
            k = end
        first = last + 1
    return tuple((a, b) for a, b in out if _KNOWN[run[a:b]])


_KNOWN = _Memo(candidates)
_SYMBOLS = _Memo(_parse)


def units(text: str) -> Iterator[tuple[int, int, str]]:
    """Start, end and characters of the cipher symbols from UTF-8; zero-width characters inside are skipped."""
    for m in _RUN.finditer(text):
        run, base = m.group(), m.start()
        if any(c in ZERO_WIDTH for c in run):
            place = [k for k, c in enumerate(run) if c not in ZERO_WIDTH]
            run = "".join(run[k] for k in place)
            yield from ((base + place[a], base + place[b - 1] + 1, run[a:b]) for a, b in _SYMBOLS[run])
        else:
            yield from ((base + a, base + b, run[a:b]) for a, b in _SYMBOLS[run])


class Mapping(dict):
    """Symbol to letter, without symbols that are honest text."""

    def __init__(self, pairs: dict[str, str]) -> None:
        super().__init__((k, v) for k, v in pairs.items() if k != v)
        lone = "".join(sorted(k for k in self if len(k) == 1))
        self.lone = re.compile(f"[{re.escape(lone)}]+") if lone else None


NOTHING = Mapping({})


def _in_word(text: str, start: int, end: int) -> bool:
    return text[start - 1 : start].isalpha() or text[end : end + 1].isalpha()


def substitute(text: str, mapping: Mapping) -> tuple[str, int]:
    """Mapped symbols become private characters, which ``translate`` turns into letters.  Also the number of symbols replaced."""
    out, table, at = [], {}, 0
    private: dict[str, str] = {}
    n = 0

    def put(start: int, end: int, symbol: str) -> None:
        nonlocal at, n
        if symbol not in private:
            private[symbol] = chr(0xF0000 + len(private))
            table[ord(private[symbol])] = mapping[symbol]
        out.extend((text[at:start], private[symbol]))
        at, n = end, n + 1

    found = [u for u in units(text) if u[2] in mapping]
    if mapping.lone is not None:
        taken = {k for a, b, _ in found for k in range(a, b)}
        found += [(k, k + 1, text[k]) for m in mapping.lone.finditer(text) if _in_word(text, m.start(), m.end()) for k in range(m.start(), m.end()) if k not in taken]
        found.sort()
    for one in found:
        put(*one)
    return ("".join([*out, text[at:]]).translate(table), n) if n else (text, 0)


def repair(text: str | None, mapping: Mapping) -> tuple[str | None, int]:
    """The text with its garbled symbols restored, and how many there were."""
    if text is None or not mapping or text.isascii():
        return text, 0
    out, n = substitute(composed(text), mapping)
    return (out, n) if n else (text, 0)


class Evidence:
    """Counts, per source, the bigrams outside of symbols (``b``), the contexts of units (``s``), and of single characters beside letters (``1``)."""

    def __init__(self, source: str, fields: tuple[str, ...]) -> None:
        self.source, self.fields = source, fields

    def __call__(self, batch: pa.RecordBatch, counts: Counter) -> None:
        sources = batch.column(self.source).to_pylist()
        # words recur: each is looked into once a batch and counts as often as it occurs; blanks and line feeds are alike at its ends
        words: dict[str | None, Counter] = {src: Counter() for src in set(sources)}
        for field in self.fields:
            for src, text in zip(sources, batch.column(field).to_pylist()):
                if text:
                    words[src].update(text.replace("\n", " ").split(" "))
        for src, own in words.items():
            plain: Counter = Counter()
            for word, n in own.items():
                at, text = 0, f" {word if word.isascii() else composed(word)} "
                found = [] if word.isascii() else list(units(text))
                for k, (start, end, symbol) in enumerate(found):
                    # what touches another symbol has no letter beside it
                    before = "" if k and found[k - 1][1] == start else text[start - 1]
                    after = "" if k + 1 < len(found) and found[k + 1][0] == end else text[end]
                    counts["s", src, symbol, before, after] += n
                    self._plain(text[at:start], n, src, plain, counts)
                    at = end
                self._plain(text[at:], n, src, plain, counts)
            for (a, b), n in plain.items():
                counts["b", src, None, a, b] += n

    @staticmethod
    def _plain(part: str, n: int, src: str | None, plain: Counter, counts: Counter) -> None:
        for pair in zip(part, part[1:]):
            plain[pair] += n
        if not part.isascii():
            for m in _HIGH.finditer(part):
                k = m.start()
                if _in_word(part, k, k + 1):
                    counts["1", src, part[k], part[k - 1 : k] or " ", part[k + 1 : k + 2] or " "] += n


class Language:
    """Likelihood of letter after letter, interpolated with the frequency of the letter alone; a letter the language does not have is dear on both its sides."""

    def __init__(self, bigrams: dict[tuple[str, str], int]) -> None:
        self.bigrams = bigrams
        self.firsts: Counter = Counter()
        for (a, _), n in bigrams.items():
            self.firsts[a] += n
        total = sum(self.firsts.values()) or 1
        seconds: Counter = Counter()
        for (_, b), n in bigrams.items():
            seconds[b] += n
        self.lone = {c: max(self.firsts[c], seconds[c]) / total for c in self.firsts.keys() | seconds.keys()}

    def step(self, a: str, b: str) -> float:
        if not a or not b:
            # beside another symbol nothing is known of one side
            return max(self.lone.get(a or b, _FLOOR), _FLOOR)
        n = self.firsts.get(a)
        return max(0.9 * self.bigrams.get((a, b), 0) / n + 0.1 * self.lone.get(b, _FLOOR) if n else _FLOOR, _FLOOR)

    def path(self, before: str, letters: str, after: str) -> float:
        """The letters between their neighbours, as a logarithm."""
        steps = [before, *letters, after]
        return sum(math.log(self.step(a, b)) for a, b in zip(steps, steps[1:]) if a or b)


def _maximised(score: dict[str, dict[str, list[float]]], weight: dict[str, list[int]], rounds: int) -> dict[str, dict[str, float]]:
    """Of every symbol the weights of its candidates, by expectation-maximisation over its places."""
    theta = {symbol: dict.fromkeys(options, 1.0) for symbol, options in score.items()}
    for _ in range(rounds):
        for symbol, options in score.items():
            own = theta[symbol]
            expected = dict.fromkeys(options, 0.1)
            for k, n in enumerate(weight[symbol]):
                logs = {o: math.log(own[o]) + s[k] for o, s in options.items()}
                top = max(logs.values())
                shares = {o: math.exp(x - top) for o, x in logs.items()}
                whole = sum(shares.values())
                for o, x in shares.items():
                    expected[o] += n * x / whole
            whole = sum(expected.values())
            theta[symbol] = {o: x / whole for o, x in expected.items()}
    return theta


def pages_in_use(places: dict[str, list[tuple[str, str, int]]], language: Language) -> frozenset[int]:
    """The pages a source was read with: again and again the one that turns most of the symbols left into letters the language has there.

    Where no letter can be known, a page that explains most symbols which are not letters throughout.
    """

    def turned(symbol: str, pages: frozenset[int], known: bool) -> bool:
        options = [c for c in candidates(symbol, pages) if not known or all(x in language.lone for x in c)]
        if not known:
            return bool(options) and not symbol.isalpha()
        own = sum(n * language.path(a, symbol, b) for a, b, n in places[symbol]) if options else 0.0
        return any(sum(n * language.path(a, c, b) for a, b, n in places[symbol]) > own for c in options)

    used: frozenset[int] = frozenset()
    for known in (True, False):
        left = set(places)
        while left and (known or not used):
            gain = {}
            for k in {k for s in left for k in _LEADS.get(s[0], ())} - used:
                hit = {s for s in left if turned(s, used | {k}, known)}
                gain[k] = (sum(n for s in hit for _, _, n in places[s]), -k, hit)
            if not gain or not (best := max(gain.items(), key=lambda x: x[1][:2]))[1][0]:
                break
            used |= {best[0]}
            left -= best[1][2]
    return used


def learn(contexts: list[tuple[str, str, str, int]], language: Language, rounds: int = 12) -> dict[str, str]:
    """The most likely letter of every unit of one source from (unit, before, after, n); one that is honest text maps to itself."""
    places: dict[str, list[tuple[str, str, int]]] = {}
    for symbol, before, after, n in contexts:
        places.setdefault(symbol, []).append((before, after, n))
    used = pages_in_use(places, language)
    options = {}
    for s in places:
        options[s] = {s, *candidates(s, used)}
        if any(len(o) > 1 and o.isalpha() for o in options[s]):
            # what reads as letters throughout may be a word of another script: it only gives way to letters the language has
            options[s] = {o for o in options[s] if o == s or len(o) > 1 and o.isalpha() or all(x in language.lone for x in o)}
    score = {s: {o: [language.path(a, o, b) for a, b, _ in seen] for o in options[s]} for s, seen in places.items()}
    weight = {s: [n for _, _, n in seen] for s, seen in places.items()}
    return {symbol: max(options.items(), key=lambda x: (x[1], x[0]))[0] for symbol, options in _maximised(score, weight, rounds).items()}


def learn_single(contexts: list[tuple[str, str, str, int]], language: Language, rounds: int = 12) -> dict[str, str]:
    """The letters of the single symbols of one source, by the language of the other sources; honest characters map to nothing."""
    places: dict[str, list[tuple[str, str, int]]] = {}
    for symbol, before, after, n in contexts:
        places.setdefault(symbol, []).append((before, after, n))
    # pages agree in ASCII, so what stands for an ASCII letter is no product of wrong decoding
    letters = {c for c, p in language.lone.items() if p >= LETTER_SHARE and c.isalpha() and not c.isascii()}

    def fits(c: str, seen: list[tuple[str, str, int]]) -> tuple[int, int]:
        """How many of the letters beside its places the letter goes with, and how many there are."""
        sides = [(pair in language.bigrams, n) for a, b, n in seen for pair, beside in (((a, c), a), ((c, b), b)) if beside.isalpha()]
        return sum(n for ok, n in sides if ok), sum(n for _, n in sides)

    def alien(symbol: str) -> bool:
        """Whether the other sources do not use the symbol in such places; what looks like an ASCII letter or a blank is a disguise and no symbol."""
        hit, of = fits(symbol, places[symbol])
        disguise = symbol in LOOKS or (symbol.isalpha() or symbol.isspace()) and unicodedata.normalize("NFKC", symbol).isascii()
        return symbol in _IN_PAGES and not disguise and of >= SEEN and 2 * hit < of and unicodedata.category(symbol)[0] != "M" and symbol not in ZERO_WIDTH + LOST

    strange = {c: places[c] for c in places if alien(c)}
    # what stands beside another such symbol has no letter there
    seen = {c: [("" if a in strange else a, "" if b in strange else b, n) for a, b, n in own] for c, own in strange.items()}
    # pages written and read in, by what they make of these symbols; the first is that nothing is wrong
    ciphers = [{c: c for c in strange}, *({c: w for c in strange if (w := written.get(r.get(c, -1), c)) in letters} for r in TABLES for written in _CHARACTERS)]
    ciphers = [dict(x) for x in dict.fromkeys(tuple(sorted(c.items())) for c in ciphers)]
    own = {(c, w): sum(n * language.path(a, w, b) for a, b, n in seen[c]) for cipher in ciphers for c, w in cipher.items()}
    least = {c: sum(n * 2 * math.log(_FLOOR) for _, _, n in seen[c]) for c in strange}
    # expectation-maximisation: symbols say which cipher the source is in, and the cipher what each symbol is
    theta = [1.0] * len(ciphers)
    best: dict[str, str] = {}
    for _ in range(rounds if strange else 0):
        expected = [0.1] * len(ciphers)
        for c in strange:
            logs = [math.log(t) + own.get((c, x.get(c)), least[c]) for t, x in zip(theta, ciphers)]
            top = max(logs)
            shares = [math.exp(x - top) for x in logs]
            whole = sum(shares)
            by: Counter = Counter()
            for k, x in enumerate(shares):
                expected[k] += x / whole
                by[ciphers[k].get(c, c)] += x
            best[c] = max(by.items(), key=lambda x: (x[1], x[0]))[0]
        theta = [x / sum(expected) for x in expected]

    def sure(c: str) -> bool:
        hit, of = fits(best[c], seen[c])
        return best[c] != c and of >= SEEN and hit >= FIT * of

    kept = {c: w for c, w in best.items() if sure(c)}
    return kept if len(kept) >= AGREED else {}


def _learn_source(bigrams: dict[tuple[str, str], int]):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        of = {kind: list(part[["a", "b", "c", "n"]].itertuples(index=False, name=None)) for kind, part in rows.groupby("kind")}
        mapping = learn(of.get("s", []), Language(bigrams))
        own = {(a, b): n for _, a, b, n in of.get("b", [])}
        others = {p: n - (0 if p[0].isascii() and p[1].isascii() else own.get(p, 0)) for p, n in bigrams.items()}
        mapping |= learn_single(of.get("1", []), Language({p: n for p, n in others.items() if n > 0}))
        kept = [(k, v) for k, v in mapping.items() if k != v]
        return pd.DataFrame({"source": [key[0]] * len(kept), "symbol": [k for k, _ in kept], "letters": [v for _, v in kept]}, dtype=object)

    return run


def mappings(counts: DataFrame) -> dict[str | None, Mapping]:
    """The mapping of every source from what ``Evidence`` counted; sources learn side by side, each in one task."""
    bigrams = counting.pairs(counts, "b")
    made = counts.where("kind in ('b', 's', '1')").groupBy("source").applyInPandas(_learn_source(bigrams), "source string, symbol string, letters string")
    out: dict[str | None, dict[str, str]] = {}
    for r in counting.bounded(made, "garbled symbols of all sources"):
        out.setdefault(r.source, {})[r.symbol] = r.letters
    return {source: Mapping(own) for source, own in out.items()}


def mapping_of(rows: DataFrame, source: str, fields: tuple[str, ...] = FIELDS) -> dict[str | None, Mapping]:
    """The mapping of every source of a table."""
    return mappings(cut(counting.counted(rows.select(F.col(source).cast("string").alias("source"), *fields), [Evidence("source", fields)])))


def _judge(it: Iterator[pa.RecordBatch], maps: dict, fields: tuple[str, ...], restore: bool) -> Iterator[pa.RecordBatch]:
    for batch in it:
        ids, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        if restore:
            done = [[repair(v, maps.get(s, NOTHING))[0] for s, v in zip(sources, column.to_pylist())] for column in batch.columns[2:]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, type=pa.string()) for c in done)], names=["id", *fields])
            continue
        out: list[tuple] = []
        for field, column in zip(fields, batch.columns[2:]):
            for i, s, v in zip(ids, sources, column.to_pylist()):
                if v and not v.isascii() and (LOST in v or repair(v, maps.get(s, NOTHING))[1]):
                    out.append((i, field))
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], type=pa.int64()), pa.array([r[1] for r in out], type=pa.string())], names=["id", "field_name"])


def picked(rows: DataFrame, key: str, source: str, fields: tuple[str, ...]) -> DataFrame:
    return rows.select(F.col(key).cast("bigint").alias("id"), F.col(source).cast("string").alias("source"), *fields)


def garbled_values(rows: DataFrame, key: str = "lemma_id", source: str = "corpus", fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Key and field of every value with a garbled sequence or a mark of a lost character."""
    maps = mapping_of(rows, source, fields)
    found = picked(rows, key, source, fields).mapInArrow(lambda it: _judge(it, maps, fields, False), "id bigint, field_name string")
    return found.dropDuplicates(["id", "field_name"]).withColumnRenamed("id", key)


def restored_values(rows: DataFrame, key: str = "lemma_id", source: str = "corpus", fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Every record once, with its fields restored."""
    maps = mapping_of(rows, source, fields)
    ddl = "id bigint, " + ", ".join(f"`{f}` string" for f in fields)
    return picked(rows, key, source, fields).mapInArrow(lambda it: _judge(it, maps, fields, True), ddl).dropDuplicates(["id"]).withColumnRenamed("id", key)
