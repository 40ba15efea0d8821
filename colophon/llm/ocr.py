"""Noise in text from scanned pages (problem 5).

Lines are read in order.  Page furniture comes first: a line that is nothing but a page number which the entry can have reached, and a
line that is a running header, that is a chapter's name, with or without a number, however it was set or read.  Lines between which only
furniture stands belong together; one that ends in a hyphen goes on in the next, unless the compound was left open on purpose
(``land- en zeezaken``).  Words are then looked up across the joints: the vocabulary is a trie of the corpus's own common words,
and a Levenshtein automaton of the token is run against it, so that every word within the bound is found.  Its edits are letters
left out, put in, replaced and exchanged, and, cheaper, one shape read as another, as scanning does it.

A candidate by shapes alone is taken as it is.  One that needs other edits is taken only for a token in small letters of five letters and more, and only
if the corpus knows it after the word before: names are spelt oddly, and are so kept apart by capitals and context.  Candidates are
ranked by their errors, by their frequency after the word before, and by their frequency.

The vocabulary holds the words that make up a fixed part of all words, which is what "common" means here and bounds its size at any scale; the
counts run over all text, inside of lines, where no word is broken.  A word is left out of it that is one of a far more frequent word by
shapes, as it is how that word is misread.

Defined results: null lines, notes and values have no noise; what problems 2 and 3 did to ``text`` is undone first and is no
noise; a repeated delivery counts once; a hyphen at the very end of a value goes nowhere and is none.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colophon.llm import counting, garbled, lookalike
from colophon.session import cut

# a common word makes up this part of all words, so there are 50,000 of them at most
COMMON = 2e-5
# a word so many times as frequent as another one that it may be read as is what was printed
FAR = 8
# letters of the shortest words that are looked up, and of those that may hold two errors of shape or one of another kind
SHORTEST, LONG = 3, 5
# costs of an error of shape and of another one
SHAPE, OTHER = 2, 3
# an entry without a known page may hold page numbers of so many digits
PAGE_DIGITS = 4

# fixed values: what scanning reads, and what was printed
CONFUSIONS = (
    ("c", "e"), ("ri", "n"), ("@", "a"), ("!", "i"), ("9", "g"), ("†", "t"), ("0", "o"), ("cl", "d"), ("5", "s"), ("1", "l"), ("6", "b"), ("ii", "u"),
    ("li", "h"), ("rn", "m"), ("vv", "w"), ("m", "in"), ("m", "rn"), ("U", "ll"), ("|", "l"), ("8", "B"), ("€", "e"), ("$", "s"), ("I", "l"),
)
_DIGITS = str.maketrans({"l": "1", "I": "1", "|": "1", "!": "1", "i": "1", "O": "0", "o": "0", "S": "5", "s": "5", "B": "8", "Z": "2", "z": "2", "b": "6", "g": "9", "q": "9", "A": "4", "E": "8"})
_LETTERS = str.maketrans({"0": "o", "1": "i", "5": "s", "8": "b", "6": "b", "9": "g", "!": "i", "|": "i", "†": "t", "@": "a", "3": "e", "4": "a", "l": "i"})
_HYPHENS = "-‐‑¬=­"
_DECOR = re.compile("[\\s\\-–—\\[\\]().,·•:\ufffd]+")
_ROMAN = re.compile(r"^\s*[IVXLCDM]+\.\s*")
_LEFT, _RIGHT = "([{\"'„“«‘<", ".,;:)]}\"'”»’>"
_SUSPECT = re.compile("|".join(re.escape(a) for a, _ in CONFUSIONS))
_YEAR = re.compile(r"[1lI|!i?\]][0-9A-Za-z?!|][0-9A-Za-z?!|][0-9A-Za-z?!|]\Z")


def strip(token: str) -> str:
    return token.lstrip(_LEFT).rstrip(_RIGHT)


class Trie:
    """Words by their letters; a node is a dict, the end of a word is under the empty key."""

    def __init__(self, words) -> None:
        self.root: dict = {}
        for w in words:
            node = self.root
            for c in w:
                node = node.setdefault(c, {})
            node[""] = w

    def within(self, token: str, most: int = 2 * SHAPE, other: bool = True) -> list[tuple[int, str]]:
        """Every word whose cost to the token is at most ``most``, cheapest first; without ``other`` errors of shape only.

        The states of the automaton are places in the token, some with letters still to come, each with its least cost; all are moved
        together along the trie, so nothing is visited that no state can reach.
        """
        n = len(token)
        found: dict[str, int] = {}
        if n and not other and token[0] not in self.root and token[0] not in _BY_FIRST and token[0] != garbled.LOST:
            # no state leaves the root
            return []
        reads = [[(r, p) for r, p in _BY_FIRST.get(c, ()) if token.startswith(r, k)] for k, c in enumerate(token)]

        def closed(states: dict[tuple[int, str], int]) -> dict[tuple[int, str], int]:
            # a letter too many in the token
            if other:
                for (at, rest), cost in list(states.items()):
                    while not rest and at < n and (cost := cost + OTHER) <= most:
                        at += 1
                        if cost < states.get((at, ""), most + 1):
                            states[at, ""] = cost
            return states

        todo = [(self.root, closed({(0, ""): 0}))]
        while todo:
            node, states = todo.pop()
            if (cost := states.get((n, ""))) is not None and (w := node.get("")) is not None:
                found[w] = cost
            if other and min(states.values()) + OTHER <= most or any(at < n and token[at] == garbled.LOST for at, _ in states):
                letters = [c for c in node if c]
            else:
                letters = {c for at, rest in states for c in ((rest[0],) if rest else (*token[at : at + 1], *(p[0] for _, p in reads[at])) if at < n else ()) if c in node}
            for c in letters:
                moved: dict[tuple[int, str], int] = {}

                def put(at: int, rest: str, cost: int) -> None:
                    if cost <= most and cost < moved.get((at, rest), most + 1):
                        moved[at, rest] = cost

                for (at, rest), cost in states.items():
                    if rest:
                        if rest[0] == c:
                            put(at, rest[1:], cost)
                        continue
                    if at < n:
                        t = token[at]
                        if t == c or t == garbled.LOST:
                            put(at + 1, "", cost)
                        for read, printed in reads[at]:
                            if printed[0] == c:
                                put(at + len(read), printed[1:], cost + SHAPE)
                        if other:
                            put(at + 1, "", cost + OTHER)
                            if token[at + 1 : at + 2] == c != t:
                                put(at + 2, t, cost + OTHER)
                    if other:
                        put(at, "", cost + OTHER)
                if moved:
                    todo.append((node[c], closed(moved)))
        return sorted((e, w) for w, e in found.items())


# costs that errors of shape alone have
_BY_SHAPE = (0, SHAPE, 2 * SHAPE)
_BY_FIRST: dict[str, list[tuple[str, str]]] = {}
for _read, _printed in CONFUSIONS:
    _BY_FIRST.setdefault(_read[0], []).append((_read, _printed))


def chapter_key(name: str) -> str:
    return "".join(c for c in _ROMAN.sub("", name).casefold().translate(_LETTERS) if c.isalpha())


class Reader:
    """What one task knows: the common words, the chapters, the words that are left open, and which word follows which."""

    def __init__(self, words: dict[str, int], chapters: set[str], open_: set[str], pairs: dict[tuple[str, str], int] | None = None) -> None:
        self.words, self.open, self.pairs = words, open_, pairs or {}
        self.trie = Trie(words)
        keys = {chapter_key(c) for c in chapters if c} - {""}
        self.chapters, self.headings = keys, Trie(keys)
        self.longest = max(map(len, keys), default=0) + 3
        # a header may be set with blanks between its letters, and a number beside it
        self.widest = 2 * self.longest + 8
        self.heads: dict[str, bool] = {}
        # tokens met before: what was printed, or nothing; of those that depend on the word before, the candidates
        self.single: dict[str, str] = {}
        self.clean: set[str] = set()
        self.known: dict[str, list[tuple[int, str]]] = {}

    # furniture

    def page_number(self, line: str, page: int | None, before: int) -> bool:
        """Whether the line is a page number the entry can have reached: it has not turned more pages than it has lines before."""
        if not any(map(str.isdigit, line)):
            return False
        core = _DECOR.sub("", line)
        # no page has a number of more than nine digits
        if not 0 < len(core) < 10 or not (core := core.translate(_DIGITS)).isdecimal():
            return False
        return len(core) <= PAGE_DIGITS if page is None else page <= int(core) <= page + before + 1

    def header(self, line: str) -> bool:
        if sum(len(t) > 2 and t.islower() for t in line.split()) > 1:
            return False
        parts = [t for t in _DECOR.sub(" ", line).split() if t]
        if not parts:
            return False
        # a number at either end is the page's
        if len(parts) > 1 and parts[-1].translate(_DIGITS).isdecimal() and any(c.isdigit() for c in parts[-1]):
            parts = parts[:-1]
        elif len(parts) > 1 and parts[0].translate(_DIGITS).isdecimal() and any(c.isdigit() for c in parts[0]):
            parts = parts[1:]
        letters = "".join(parts)
        if len(letters) > self.longest:
            return False
        if sum(c.isalpha() for c in letters) < 3 or len(parts) > 1 and any(len(p) > 2 for p in parts) and not any(c.isupper() for c in parts[-1]):
            return False
        if letters not in self.heads:
            key = chapter_key(letters)
            self.heads[letters] = key in self.chapters or (len(key) >= 6 and letters[:1].isupper() | letters[:1].isdigit() and bool(self.headings.within(key, OTHER if len(key) < 8 else 2 * OTHER)))
        return self.heads[letters]

    def kind(self, line: str, page: int | None, before: int) -> str:
        if len(line) > self.widest:
            line = line.strip()
            if len(line) > self.widest:
                return ""
        if not line.strip():
            return "blank"
        if self.page_number(line, page, before):
            return "page_number"
        return "header" if self.header(line) else ""

    # words

    def candidates(self, token: str) -> list[tuple[int, str]]:
        """The cheapest common words of a token: by shapes, else, for one in small letters, by any edits."""
        found = self.trie.within(token, 2 * SHAPE, False) if _SUSPECT.search(token) or garbled.LOST in token else []
        found = [(e, w) for e, w in found if e <= SHAPE or len(w) >= LONG]
        if not found and len(token) >= LONG and token.isalpha() and token.islower():
            found = self.trie.within(token, OTHER if len(token) < 9 else 2 * OTHER)
        return found

    def best(self, token: str, before: str) -> str | None:
        """The common word that was printed, if the token is a misreading of one."""
        if token in self.words or len(token) < SHORTEST:
            return None
        if token not in self.known:
            if len(self.known) > 200_000:
                self.known.clear()
            self.known[token] = self.candidates(token)
        options = [o for o in self.known[token] if o[0] in _BY_SHAPE or (before, o[1]) in self.pairs]
        if not options or not options[0][0]:
            return None
        return min(options, key=lambda o: (o[0], -math.log1p(self.pairs.get((before, o[1]), 0)), -self.words[o[1]], o[1]))[1]

    def year(self, token: str) -> bool:
        if not _YEAR.match(token) or token.isdecimal() or sum(c.isdigit() for c in token) < 2 or token[1].isalpha() and token[1] not in "lIOSBbEGZ" or token[-1] in "vrab" and token[:3].isdecimal() and token[-1] != "b":
            return False
        plain = token.replace("?", "5").replace("]", "1").translate(_DIGITS)
        return plain[0] == "1"

    def read(self, lines: list[str], page: int | None, every: bool = True) -> tuple[list[str], list[str], list[list[tuple[str, int, int, str]]]]:
        """Of every line its furniture kind and whether it ends inside a word (``hyphen``); of every joined word its token, the line it
        begins in, the line of its first wrong character (-1: none) and what was printed; without ``every`` clean words may be left out."""
        kinds = [self.kind(t, page, k) for k, t in enumerate(lines)]
        content = [i for i, k in enumerate(kinds) if not k]
        ends = [""] * len(lines)
        words: list[list[tuple[str, int, int, str]]] = []
        pending: list[tuple[str, int]] = []
        before = ""
        for place, i in enumerate(content):
            tokens = lines[i].split()
            goes_on = False
            if place + 1 < len(content) and tokens and tokens[-1][-1] in _HYPHENS and any(map(str.isalpha, stem := tokens[-1][:-1])):
                follow = lines[content[place + 1]].lstrip().split(maxsplit=1)
                first = follow[0] if follow else ""
                open_ = strip(stem).casefold() in self.open and strip(first).casefold() in ("en", "of")
                upper = first[:1].isupper() and not stem[-1].isupper() or not (stem[-1].isalpha() or _SUSPECT.match(stem[-1]))
                if first and (first[0].isalpha() or first[0] == garbled.LOST or _SUSPECT.match(first)) and not open_ and not upper:
                    goes_on = True
                    ends[i] = "hyphen"
            row: list[tuple[str, int, int, str]] = []
            if not every and not goes_on and not pending and tokens and self.clean.issuperset(tokens):
                before = tokens[-1]
                continue
            for k, token in enumerate(tokens):
                last = goes_on and k == len(tokens) - 1
                if not last and not (pending and k == 0):
                    # most words have been met before
                    fixed = self.single.get(token)
                    if fixed is None:
                        row.append(self._word([(token, i)], strip(before)))
                        options = self.known.get(strip(token), ())
                        if len(options) < 2 and all(o[0] in _BY_SHAPE for o in options):
                            if len(self.single) > 200_000:
                                self.single.clear()
                                self.clean.clear()
                            self.single[token] = row[-1][3]
                            if row[-1][2] < 0:
                                self.clean.add(token)
                    else:
                        row.append((token, i, i if fixed else -1, fixed))
                    before = row[-1][3] or token
                    continue
                part = token[:-1] if last and token[-1:] in _HYPHENS else token
                if last and not part:
                    continue
                pending = [*pending, (part, i)] if pending and k == 0 else [(part, i)]
                if last:
                    continue
                row.append(self._word(pending, strip(before)))
                before = row[-1][3] or row[-1][0]
                pending = []
            words.append(row)
        if pending:
            words.append([self._word(pending, strip(before))])
        return kinds, ends, words

    def _word(self, parts: list[tuple[str, int]], before: str) -> tuple[str, int, int, str]:
        raw = "".join(p for p, _ in parts)
        for glue in ("", "-") if len(parts) > 1 else ("",):
            text = glue.join(p for p, _ in parts)
            core = strip(text)
            head = len(text) - len(text.lstrip(_LEFT))
            if core in self.words:
                return raw if not glue else text, parts[0][1], -1, ""
            printed = self.best(core, before)
            if printed is None and len(core) > 4 and core[-1] in "!?" and core[:-1] in self.words:
                return text, parts[0][1], -1, ""
            if printed is None and len(parts) == 1 and self.year(core):
                printed = core
            if printed is not None:
                at = head + next((k for k, (a, b) in enumerate(zip(core, printed)) if a != b), 0)
                if printed == core:
                    at = head + next(k for k, c in enumerate(core) if not c.isdigit())
                where = parts[0][1]
                for part, line in parts:
                    where = line
                    if at < len(part):
                        break
                    at -= len(part) + len(glue)
                fixed = text.replace(core, printed, 1) if printed != core else text.replace(core, core.translate(_DIGITS), 1)
                return text, parts[0][1], where, fixed
        return raw, parts[0][1], -1, ""


def noise(reader: Reader, lines: list[str], page: int | None) -> Iterator[tuple[int, str]]:
    """Line and kind of every place of noise."""
    kinds, ends, words = reader.read(lines, page, False)
    for i, (kind, end) in enumerate(zip(kinds, ends)):
        if kind in ("page_number", "header"):
            yield i, kind
        if end:
            yield i, end
    for row in words:
        for _, _, where, _ in row:
            if where >= 0:
                yield where, "misread"


def paragraphs(reader: Reader, lines: list[str], page: int | None, breaks: set[int]) -> list[str]:
    """Continuous text: without furniture, with joined and restored words; a paragraph begins at the lines in ``breaks``."""
    _, _, words = reader.read(lines, page)
    out: list[list[str]] = [[]]
    seen = -1
    for row in words:
        for token, line, _, fixed in row:
            if line != seen and out[-1] and any(seen < b <= line for b in breaks):
                out.append([])
            seen = line
            out[-1].append(fixed or token)
    return [" ".join(p) for p in out if p]


def ends_early(lines: list[str]) -> set[int]:
    """Lines before which a paragraph ends: the line before closes a sentence well short of the margin."""
    width = max(map(len, lines), default=0)
    return {i + 1 for i, t in enumerate(lines) if t.rstrip().endswith((".", "?", "!")) and len(t) < 0.75 * width}


# distribution

def _texts(rows: DataFrame) -> DataFrame:
    """Lines, text and notes as plain lists of text."""
    return rows.select(F.col("corpus").cast("string").alias("source"), F.transform("lines", lambda x: x["text"]).alias("lines"), "text", F.map_values("footnotes").alias("footnotes"), "toc_chapter")


def _lines(batch: pa.RecordBatch) -> Iterator[str]:
    lines, texts, notes = (batch.column(k).to_pylist() for k in ("lines", "text", "footnotes"))
    for ls, text, fn in zip(lines, texts, notes):
        yield from filter(None, ls or ())
        for value in (text, *(fn or ())):
            if value:
                yield from value.split("\n")


class _Cores(dict):
    """Token to its common word, empty if it is none."""

    def __init__(self, words: frozenset[str]) -> None:
        super().__init__()
        self.words = words

    def __missing__(self, token: str) -> str:
        core = strip(token)
        core = core if core in self.words else ""
        if len(self) < 500_000:
            self[token] = core
        return core


def _count(batch: pa.RecordBatch, counts: Counter) -> None:
    """Words (``w``, and ``t`` all of them) inside of lines, words left open before *en* and *of* (``o``), and chapters (``h``)."""
    words: Counter = Counter()
    for line in _lines(batch):
        tokens = line.split()
        words.update(tokens[1:-1])
        if "- " in line:
            for a, b in zip(tokens, tokens[1:]):
                if a[-1] == "-" and len(a) > 1 and b in ("en", "of"):
                    counts["o", None, None, a[:-1].casefold(), None] += 1
    counts["t", None, None, None, None] += sum(words.values())
    for token, n in words.items():
        core = strip(token)
        if len(core) >= SHORTEST and core[0].islower() and core[-1] != "-" and core.replace("-", "").isalpha():
            counts["w", None, None, core, None] += n
    for chapter in batch.column("toc_chapter").to_pylist():
        if chapter:
            counts["h", None, None, _ROMAN.sub("", chapter), None] += 1


class _Pairs:
    """Counts neighbouring words of the vocabulary (``p``)."""

    def __init__(self, words: frozenset[str]) -> None:
        self.words, self.cores = words, None

    def __call__(self, batch: pa.RecordBatch, counts: Counter) -> None:
        cores = self.cores = self.cores or _Cores(self.words)
        pairs: Counter = Counter()
        for line in _lines(batch):
            known = list(map(cores.__getitem__, line.split()))
            pairs.update(zip(known, known[1:]))
        for (a, b), n in pairs.items():
            if a and b:
                counts["p", None, None, a, b] += n


def vocabulary(counts: dict[str, int]) -> dict[str, int]:
    """Words without those that are how a far more frequent one is misread."""
    trie = Trie(counts)
    far = lambda w, n: any(e and counts[c] >= FAR * n and (e <= SHAPE or len(c) >= LONG) for e, c in trie.within(w, 2 * SHAPE, False))
    return {w: n for w, n in counts.items() if not (_SUSPECT.search(w) and far(w, n))}


def learn(rows: DataFrame) -> tuple[tuple, dict, dict]:
    """What a ``Reader`` knows, the mappings of wrong decoding and the letter bigrams.  One pass counts all that needs no vocabulary, a second one
    the word pairs.  Common words and pairs make up a fixed part of all, which bounds them; chapters are the headings of printed works, and too
    many of them are an error."""
    values = _texts(rows)
    counts = cut(counting.counted(values, [_count, garbled.Evidence("source", ("text",)), lookalike.Letters(("text",))]))
    total = counts.where("kind = 't'").agg(F.sum("n")).first()[0] or 0
    common = counts.where(F.col("kind").isin("w", "o") & (F.col("n") >= COMMON * total)).select("kind", "b", "n").collect()
    words = vocabulary({r.b: r.n for r in common if r.kind == "w"})
    open_ = {r.b for r in common if r.kind == "o"}
    chapters = {r.b for r in counting.bounded(counts.where("kind = 'h'").select("b"), "chapters")}
    pairs = counting.pairs(cut(counting.counted(values, [_Pairs(frozenset(words))])), "p")
    return (words, chapters, open_, pairs), garbled.mappings(counts), lookalike.letter_bigrams(counts)


def _judge(it: Iterator[pa.RecordBatch], made: tuple, maps: dict, bigrams: dict, reflow: bool) -> Iterator[pa.RecordBatch]:
    reader = Reader(*made)
    for batch in it:
        out: list[tuple] = []
        for key, corpus, page, own, seqs, zones, text, notes, values in zip(*(c.to_pylist() for c in batch.columns)):
            listed = sorted(((seq is None, seq, k) for k, (seq, t) in enumerate(zip(seqs or (), own or ())) if t is not None))
            found = []
            if listed:
                order = [k for _, _, k in listed]
                turns = {n for n in range(1, len(order)) if zones[order[n]] != zones[order[n - 1]]}
                found.append(("lines", [own[k] for k in order], [str(seqs[k]) for k in order], turns))
            if text:
                if not text.isascii():
                    text = lookalike.unify(garbled.repair(text, maps.get(corpus, garbled.NOTHING))[0], bigrams)[0]
                split = text.split("\n")
                found.append(("text", split, [str(k) for k in range(1, len(split) + 1)], None))
            for note, value in zip(notes or (), values or ()):
                if value:
                    split = value.split("\n")
                    found.append(("footnotes", split, [note] * len(split), set()))
            for field, split, keys, breaks in found:
                if reflow:
                    parts = paragraphs(reader, split, page, ends_early(split) if breaks is None else breaks)
                    out.extend((key, field, keys[0] if field == "footnotes" else "", k, p) for k, p in enumerate(parts, 1))
                else:
                    out.extend((key, field, k, kind) for k, kind in dict.fromkeys((keys[i], kind) for i, kind in noise(reader, split, page)))
        types = [pa.int64(), pa.string(), pa.string(), pa.int32(), pa.string()] if reflow else [pa.int64(), pa.string(), pa.string(), pa.string()]
        names = ["lemma_id", "field_name", "item_key", "paragraph", "clean"] if reflow else ["lemma_id", "field_name", "item_key", "kind"]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names=names)


def _part(name: str) -> Column:
    """One field of all lines."""
    return F.transform("lines", lambda x: x[name]).alias(name)


def _run(rows: DataFrame, reflow: bool) -> DataFrame:
    made, maps, bigrams = learn(rows)
    picked = rows.select(F.col("lemma_id").cast("bigint").alias("lemma_id"), "corpus", "toc_page", _part("text"), _part("seq"), _part("zone"), F.col("text").alias("value"), F.map_keys("footnotes").alias("notes"), F.map_values("footnotes").alias("values"))
    ddl = "lemma_id bigint, field_name string, item_key string, " + ("paragraph int, clean string" if reflow else "kind string")
    return picked.mapInArrow(lambda it: _judge(it, made, maps, bigrams, reflow), ddl)


def scan_noise(rows: DataFrame) -> DataFrame:
    """lemma_id, field_name, item_key and kind of every place of noise, once."""
    return _run(rows, False).distinct()


def clean_paragraphs(rows: DataFrame) -> DataFrame:
    """The readable paragraphs of every entry's lines, text and notes."""
    return _run(rows, True).dropDuplicates(["lemma_id", "field_name", "item_key", "paragraph"])
