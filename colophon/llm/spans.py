"""Long exact spans shared between documents (problem 9).

A character is shared if it lies in a window of ``length`` code points that also occurs in another document.  One suffix automaton of
a whole corpus, or of shards that every document is streamed against, grows with the square of the corpus; so documents are
first led to small shards in which all that they can share is found.

1. Every window is owned by one anchor: the k-gram of least hash inside it, the leftmost of equals.  Equal windows own equal anchors
   at the same place.  Each document gives one row an anchor: its hash, and the hash of the region its windows cover.  Anchors
   of one document only are dropped; about two of a hundred positions are anchors.
   Each row has the place of its region too, so the texts are not needed to settle most of them.
2. Regions that occur in two documents are shared whole.  A region under a shared anchor that no other document repeats holds
   the end of a span.
3. Only the regions under such an anchor, one representative of each repeated one, are cut out of their texts.  They are a shard: a
   suffix automaton of them, whose states know the least and the greatest document, gives every region's matching statistics
   against the other documents; stretches of the threshold and more are kept.  An anchor with more than ``SHARD`` different
   regions is no shard: its windows are compared one by one, by hash and with the least and the greatest document, so no group is
   ever gathered that is not bounded.
4. Intervals are merged to the longest unbroken stretches.

A passage that a third of all documents hold costs one row a document and anchor; the counts are combined before the shuffle, the rows of a hot
anchor are split by the adaptive join; pairs of documents are never formed.  Hashes have 64 bits over code points that are
scrambled first, and are compared within their anchor.

Defined results: null, empty and short texts have no spans; rows of one ``doc_id`` never count as each other's other document;
texts of any length are processed whole, in overlapping segments.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colophon.session import cut

LENGTH = 200
GRAM = 100
SHARD = 64
SEGMENT = 1 << 20
CHUNK = 1 << 16
_PLACE = np.uint64((1 << 24) - 1)
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: list[np.ndarray] = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _scramble(x: np.ndarray) -> np.ndarray:
    """A fixed mixing of 64-bit numbers in which every input bit reaches every output bit."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if len(_POWERS[0]) < n:
        for at, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            grown = np.full(2 * n, base, dtype=np.uint64)
            grown[0] = 1
            _POWERS[at] = np.multiply.accumulate(grown)
    return _POWERS[0], _POWERS[1]


class Hashes:
    """Hashes of any stretch of one text in constant time, equal stretches having equal hashes wherever they stand."""

    def __init__(self, codes: np.ndarray) -> None:
        n = len(codes)
        self.up, self.down = _powers(n + 1)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_scramble(codes.astype(np.uint64)) * self.up[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _scramble((self.sums[end] - self.sums[start]) * self.down[start])

    def grams(self, k: int) -> np.ndarray:
        return _scramble((self.sums[k:] - self.sums[:-k]) * self.down[: len(self.sums) - k])


def sliding_least(keys: np.ndarray, w: int) -> np.ndarray:
    """Least of every w neighbours, from running minima of blocks."""
    n = len(keys)
    blocks = -(-n // w)
    padded = np.full(blocks * w, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = keys
    grid = padded.reshape(blocks, w)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - w + 1], ahead[w - 1 : n])


class Group:
    """Anchors of a group of texts that are hashed as one: of every anchor its text, first and last window, hash and region's hash.

    Windows that would reach from one text into the next are none.  ``place`` turns a position into one within its text.
    """

    def __init__(self, pieces: list[tuple[int, int, np.ndarray]], length: int, gram: int) -> None:
        sizes = np.fromiter((len(p[2]) for p in pieces), dtype=np.int64, count=len(pieces))
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        self.hashes = Hashes(np.concatenate([p[2] for p in pieces]))
        grams = self.hashes.grams(gram)
        keys = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        place = (sliding_least(keys, length - gram + 1) & _PLACE).astype(np.int64)
        window = np.concatenate([np.arange(s, s + n - length + 1) for s, n in zip(starts, sizes)])
        piece = np.repeat(np.arange(len(pieces)), sizes - length + 1)
        at = place[window]
        turn = np.flatnonzero((np.diff(at) != 0) | (np.diff(piece) != 0)) + 1
        self.first, self.last = window[np.concatenate(([0], turn))], window[np.concatenate((turn, [len(window)])) - 1]
        own = piece[np.concatenate(([0], turn))]
        at = at[np.concatenate(([0], turn))]
        shape = _scramble(((at - self.first).astype(np.uint64) << np.uint64(32)) | (self.last - self.first).astype(np.uint64))
        self.text = np.fromiter((p[0] for p in pieces), dtype=np.int64, count=len(pieces))[own]
        self.shift = (np.fromiter((p[1] for p in pieces), dtype=np.int64, count=len(pieces)) - starts)[own]
        self.h, self.c = grams[at].view(np.int64), _scramble(self.hashes.of(self.first, self.last + length) ^ shape).view(np.int64)


def groups(texts: list[str | None], length: int, gram: int) -> Iterator[Group]:
    """Anchors of all texts, in groups of about ``SEGMENT`` windows; a longer text is cut into segments that overlap."""
    pieces: list[tuple[int, int, np.ndarray]] = []
    total = 0
    for k, text in enumerate(texts):
        if text is None or len(text) < length:
            continue
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        for offset in range(0, len(codes) - length + 1, SEGMENT):
            part = codes[offset : offset + SEGMENT + length - 1]
            if pieces and total + len(part) > SEGMENT:
                yield Group(pieces, length, gram)
                pieces, total = [], 0
            pieces.append((k, offset, part))
            total += len(part)
    if pieces:
        yield Group(pieces, length, gram)


def _anchor_rows(it: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    for batch in it:
        known = batch.filter(batch.column(0).is_valid())
        ids, versions = (known.column(k).to_numpy() for k in (0, 2))
        for g in groups(known.column(1).to_pylist(), length, gram):
            columns = (ids[g.text], versions[g.text], g.h, g.c, g.first + g.shift, g.last + g.shift + length)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["doc_id", "v", "h", "c", "a", "b"])


class SuffixAutomaton:
    """All substrings of several texts, each state with the least and the greatest document that has them."""

    def __init__(self) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length, self.low, self.high = [-1], [0], [_NO_DOC], [-_NO_DOC]

    def _state(self, length: int, following: dict[str, int], link: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        self.low.append(_NO_DOC)
        self.high.append(-_NO_DOC)
        return len(self.link) - 1

    def _split(self, p: int, c: str, q: int) -> int:
        """A copy of state q for the shorter strings that reach it from p."""
        nxt, link = self.next, self.link
        copy = self._state(self.length[p] + 1, dict(nxt[q]), link[q])
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = copy
            p = link[p]
        link[q] = copy
        return copy

    def add(self, text: str, low: int, high: int) -> None:
        """Add a text that documents ``low`` and ``high`` hold."""
        nxt, link, length = self.next, self.link, self.length
        last = 0
        for c in text:
            q = nxt[last].get(c)
            if q is not None:
                last = q if length[q] == length[last] + 1 else self._split(last, c, q)
            else:
                new, p = self._state(length[last] + 1, {}, 0), last
                while p >= 0 and c not in nxt[p]:
                    nxt[p][c] = new
                    p = link[p]
                if p >= 0:
                    q = nxt[p][c]
                    link[new] = q if length[q] == length[p] + 1 else self._split(p, c, q)
                last = new
            self.low[last] = min(self.low[last], low)
            self.high[last] = max(self.high[last], high)

    def close(self) -> None:
        """Hand the documents of every state on to the suffixes of its strings."""
        for v in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            u = self.link[v]
            self.low[u] = min(self.low[u], self.low[v])
            self.high[u] = max(self.high[u], self.high[v])

    def matches(self, text: str, doc: int) -> Iterator[int]:
        """For each end in the text the length of the longest stretch that another document has too."""
        nxt, link, length, low, high = self.next, self.link, self.length, self.low, self.high
        v = held = 0
        for c in text:
            while v and c not in nxt[v]:
                v = link[v]
                held = length[v]
            v = nxt[v].get(c, 0)
            held = held + 1 if v else 0
            u, n = v, held
            while u and low[u] == doc and high[u] == doc:
                u = link[u]
                n = length[u]
            yield n if u else 0


_NO_DOC = 1 << 63


def _shard_spans(it: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Shared stretches of the regions under one anchor, for anchor after anchor; rows come sorted by anchor."""

    def solve(shard: list[tuple]) -> Iterator[tuple[int, int, int]]:
        automaton = SuffixAutomaton()
        for _, doc, _, _, other, text in shard:
            automaton.add(text, min(doc, other), max(doc, other))
        automaton.close()
        for kind, doc, a, _, _, text in shard:
            if kind:
                start = end = None
                for e, n in enumerate(automaton.matches(text, doc), 1):
                    if n >= length:
                        if start is not None and e - n <= end:
                            start, end = min(start, e - n), e
                            continue
                        if start is not None:
                            yield doc, a + start, a + end
                        start, end = e - n, e
                if start is not None:
                    yield doc, a + start, a + end

    now, shard = None, []
    for batch in it:
        out: list[tuple[int, int, int]] = []
        for h, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if h != now and shard:
                out.extend(solve(shard))
                shard = []
            now = h
            shard.append(tuple(row))
        yield _spans_batch(out)
    if shard:
        yield _spans_batch(list(solve(shard)))


def _spans_batch(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], names=["doc_id", "a", "b"])


def _windows(it: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The windows of regions, with their hashes."""
    names = ["own", "doc_id", "a", "b", "other", "h", "w"]
    for batch in it:
        out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in names]
        for h, own, doc, start, _, other, region in zip(*(c.to_pylist() for c in batch.columns)):
            w = Hashes(np.frombuffer(region.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)).grams(length).view(np.int64)
            a = start + np.arange(len(w))
            for column, part in zip(out, (np.full(len(w), own), np.full(len(w), doc), a, a + length, np.full(len(w), other), np.full(len(w), h), w)):
                column.append(part.astype(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=names)


def shared_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard: int = SHARD) -> DataFrame:
    """doc_id, span_start, span_end of the longest unbroken stretches of shared characters."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where(f"doc_id is not null and text is not null and length(text) >= {length}").withColumn("v", F.xxhash64("text"))
    rows = docs.mapInArrow(lambda it: _anchor_rows(it, length, gram), "doc_id bigint, v bigint, h bigint, c bigint, a bigint, b bigint")
    shared = rows.groupBy("h").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y")).where("x <> y").select("h")
    rows = cut(rows.join(shared, "h", "left_semi"))
    regions = rows.groupBy("h", "c").agg(F.min("doc_id").alias("dmin"), F.max("doc_id").alias("dmax"))
    under = regions.groupBy("h").agg(F.count("*").alias("n"), F.max(F.col("dmin") == F.col("dmax")).alias("ends"))
    states = regions.join(under, "h").select("h", "c", "dmin", "dmax", "ends", (F.col("n") > shard).alias("many"))
    placed = cut(rows.join(states, ["h", "c"]))
    whole = placed.where("dmin <> dmax").select("doc_id", "a", "b")
    # of a repeated region that ends elsewhere only the first document stands for the region
    need = placed.where("ends and doc_id = dmin").select("h", (F.col("dmin") == F.col("dmax")).cast("bigint").alias("own"), "doc_id", "v", "a", "b", F.col("dmax").alias("other"), "many")
    parts = cut(_cut_out(docs, need, length))
    shards = parts.where("not many").drop("many").repartition("h").sortWithinPartitions("h")
    ends = shards.mapInArrow(lambda it: _shard_spans(it, length), "doc_id bigint, a bigint, b bigint")
    windows = parts.where("many").drop("many").mapInArrow(lambda it: _windows(it, length), "own bigint, doc_id bigint, a bigint, b bigint, other bigint, h bigint, w bigint")
    twice = windows.groupBy("h", "w").agg(F.min(F.least("doc_id", "other")).alias("x"), F.max(F.greatest("doc_id", "other")).alias("y")).where("x <> y").select("h", "w")
    found = whole.unionByName(windows.where("own = 1").join(twice, ["h", "w"], "left_semi").select("doc_id", "a", "b")).unionByName(ends)
    own = Window.partitionBy("doc_id").orderBy("a", "b")
    reach = F.max("b").over(own.rowsBetween(Window.unboundedPreceding, -1))
    islands = found.withColumn("new", F.when(reach >= F.col("a"), 0).otherwise(1)).withColumn("island", F.sum("new").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    return islands.groupBy("doc_id", "island").agg(F.min("a").cast("int").alias("span_start"), F.max("b").cast("int").alias("span_end")).drop("island")


def _cut_out(docs: DataFrame, need: DataFrame, length: int) -> DataFrame:
    """The regions with their characters.  Long texts are cut into chunks first, so that none is run through for each of its regions.

    A region has at most ``2 length`` characters, as its windows all hold its anchor.
    """
    size = F.greatest(F.floor((F.length("text") - 1) / CHUNK), F.lit(0))
    chunks = docs.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), size)))
    piece = F.when(F.length("text") <= CHUNK, F.col("text")).otherwise(F.col("text").substr((F.col("chunk") * CHUNK + 1).cast("int"), F.lit(CHUNK + 2 * length)))
    chunks = chunks.select("doc_id", "v", "chunk", piece.alias("piece"))
    joined = need.withColumn("chunk", F.floor(F.col("a") / CHUNK)).join(chunks, ["doc_id", "v", "chunk"])
    region = F.col("piece").substr((F.col("a") - F.col("chunk") * CHUNK + 1).cast("int"), (F.col("b") - F.col("a")).cast("int"))
    # rows of one document that are repeated give their regions once
    return joined.select("h", "own", "doc_id", "a", "b", "other", region.alias("region"), "many").dropDuplicates(["h", "own", "doc_id", "a", "region"])


def shared_amount(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Of every document its length, its shared characters and their part of it."""
    sums = spans.groupBy("doc_id").agg(F.count("*").alias("n_spans"), F.sum(F.col("span_end") - F.col("span_start")).alias("shared_chars"))
    sizes = docs.select("doc_id", F.length("text").alias("n_chars")).where("doc_id is not null").groupBy("doc_id").agg(F.max("n_chars").alias("n_chars"))
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("n_spans", "shared_chars")}
    return sizes.join(sums, "doc_id", "left").withColumns(zero).withColumn("shared_part", F.when(F.col("n_chars") > 0, F.col("shared_chars") / F.col("n_chars")).otherwise(0.0))
