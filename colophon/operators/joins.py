"""Joins of records with registers, metadata and files."""

from __future__ import annotations

import os
import tempfile
import uuid
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colophon.functions import text as T
from colophon.session import cut, ship_file, shipped


def last_wins(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row a key: the last one by ``order``.  Partial maxima are taken before the shuffle."""
    rest = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*key, "_r.*")


def overlay(base: DataFrame, better: DataFrame, key: list[str], columns: list[str], filled) -> DataFrame:
    """Take each column from the better table where it is filled there, independently of the others."""
    renamed = better.select(*key, *[F.col(c).alias(f"_{c}") for c in columns])
    joined = base.join(renamed, key, "left")
    return joined.withColumns({c: F.when(filled(F.col(f"_{c}")), F.col(f"_{c}")).otherwise(F.col(c)) for c in columns}).drop(*[f"_{c}" for c in columns])


def verify(expected: DataFrame, present: DataFrame, key: list[str], readable: Column, same: Column) -> DataFrame:
    """Status of every expected record: missing, unreadable, mismatch or ok, in this order."""
    joined = expected.join(present.withColumn("_here", F.lit(True)), key, "left")
    return joined.withColumn("status", F.when(F.col("_here").isNull(), "missing").when(~F.coalesce(readable, F.lit(False)), "unreadable").when(~F.coalesce(same, F.lit(False)), "mismatch").otherwise("ok")).drop("_here")


def pair_in_order(left: DataFrame, right: DataFrame, part: list[str], order: str) -> DataFrame:
    """The k-th row of one side with the k-th of the other; the shorter side ends it."""
    from pyspark.sql import Window

    numbered = lambda d: d.withColumn("_k", F.row_number().over(Window.partitionBy(*part).orderBy(order))).drop(order)
    return numbered(left).join(numbered(right), [*part, "_k"]).withColumnRenamed("_k", "k")


# characters of a chunk of text; lengths of grams: a start is looked for by its first and its last letters, as many as the longest gram it can hold
CHUNK = 16_384
GRAMS = (64, 48, 40, 32, 28, 24, 22, 20, 18, 16, 14, 12, 10, 8, 6, 4, 3, 2, 1)
# bits a gram of the filter that texts are held against before the shuffle, and the most bits it may have (16 MB): beyond that it lets more through, and loses nothing
FILTER_BITS, MOST_BITS = 32, 1 << 27

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


@lru_cache(maxsize=8)
def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.full(n, base, np.uint64))


def _sums(text: str) -> np.ndarray:
    """Sums of letters times powers of the base, from which ``_hashes`` has those of any gram."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = 1 << max(len(points), 1).bit_length()
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum((points + np.uint64(1)) * _powers(_BASE, size)[: len(points)])])


def _hashes(sums: np.ndarray, at: np.ndarray | slice, end: np.ndarray | slice) -> np.ndarray:
    """Hashes of the grams from ``at`` to ``end``, wherever in a text they stand."""
    runs = (sums[end] - sums[at]) * _powers(_INVERSE, 1 << len(sums).bit_length())[at]
    runs ^= runs >> np.uint64(32)
    runs *= np.uint64(0xD6E8FEB86659FD93)
    return runs ^ runs >> np.uint64(29)


def _bits(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of the filter that each hash has."""
    return hashes & np.uint64(bits - 1), hashes >> np.uint64(32) & np.uint64(bits - 1)


def _set(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    return words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1) == 1


def _chunks(it: Iterator[pa.RecordBatch], between: str) -> Iterator[pa.RecordBatch]:
    """Lines in order, gathered to chunks with the place at which each begins."""
    seqs, places, texts, n = [], [], [], 0

    def made():
        return pa.RecordBatch.from_pydict({"chunk": pa.array([seqs[0]], pa.int64()), "text": ["".join(texts)], "places": pa.array([places], pa.list_(pa.int32())), "seqs": pa.array([seqs], pa.list_(pa.int64()))})

    for batch in it:
        for seq, text in zip(*(c.to_pylist() for c in batch.columns)):
            # lines of one seq stay together, as chunks are told apart by their first
            if n >= CHUNK and seq != seqs[-1]:
                yield made()
                seqs, places, texts, n = [], [], [], 0
            seqs.append(seq)
            places.append(n)
            texts.append(text + between)
            n += len(text) + len(between)
    if seqs:
        yield made()


def _following(it: Iterator[pa.RecordBatch], longest: int) -> Iterator[pa.RecordBatch]:
    """Beginnings of chunks, last chunk first: what stands after each, as far as the longest start may reach."""
    after = ""
    for batch in it:
        chunks, out = batch.column(0).to_pylist(), []
        for head in batch.column(1).to_pylist():
            out.append(after)
            after = (head + after)[:longest]
        yield pa.RecordBatch.from_pydict({"chunk": pa.array(chunks, pa.int64()), "after": pa.array(out, pa.string())})


def _text_grams(it: Iterator[pa.RecordBatch], grams: list[int], name: str) -> Iterator[pa.RecordBatch]:
    """The grams of chunks that are likely wanted."""
    words = np.load(shipped(name), mmap_mode="r")
    for batch in it:
        for chunk, text, after in zip(*(batch.column(c).to_pylist() for c in ("chunk", "text", "after"))):
            sums = _sums(text + after)
            for g in grams:
                if (n := len(sums) - g) > 0:
                    found = _hashes(sums, slice(0, n), slice(g, g + n))
                    one, two = _bits(found, 64 * len(words))
                    near = np.flatnonzero(_set(words, one))
                    found = found[near[_set(words, two[near])]]
                    found = np.unique(found).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), g, np.int32)), pa.array(found), pa.array(np.full(len(found), chunk, np.int64))], names=["letters", "gram", "chunk"])


def _start_grams(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and the last gram of a start: a text has both where the start stands."""
    sizes = np.array(GRAMS[::-1])
    for batch in it:
        for k in range(0, batch.num_rows, 512):
            texts = batch.column(0).slice(k, 512)
            said = texts.to_pylist()
            n = np.array([len(x) for x in said])
            ends, sums = np.cumsum(n), _sums("".join(said))
            g = sizes[np.searchsorted(sizes, n, "right") - 1]
            first, last = _hashes(sums, ends - n, ends - n + g), _hashes(sums, ends - g, ends)
            yield pa.RecordBatch.from_arrays([pa.chunked_array([texts, texts]).combine_chunks(), pa.array(np.tile(g, 2), pa.int32()), pa.array(np.concatenate([first, last]).view(np.int64))], names=["_f", "letters", "gram"])


def _filter_words(it: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for batch in it:
        at = np.concatenate(_bits(batch.column(0).to_numpy().view(np.uint64), bits))
        yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int32)), pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))], names=["word", "mask"])


def _ship_filter(wanted: DataFrame) -> str:
    """A file with the bits of all wanted grams, for the workers."""
    bits = min(MOST_BITS, 1 << max(16, (FILTER_BITS * wanted.count()).bit_length()))
    masks = wanted.select("gram").mapInArrow(lambda it: _filter_words(it, bits), "word int, mask bigint").groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    words = np.zeros(bits // 64, np.uint64)
    words[masks.column("word").to_numpy()] = masks.column("mask").to_numpy().view(np.uint64)
    path = os.path.join(tempfile.mkdtemp(prefix="colophon-grams-"), f"grams-{uuid.uuid4().hex}.npy")
    np.save(path, words)
    return ship_file(wanted.sparkSession, path)


def _find(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        out = []
        for text, after, places, seqs, starts in zip(*(batch.column(c).to_pylist() for c in ("text", "after", "places", "seqs", "starts"))):
            whole = text + after
            # a start that begins in the text after the chunk is found in its own chunk
            out += [(x, seqs[bisect_right(places, at) - 1]) for x in starts if 0 <= (at := whole.find(x)) < len(text)]
        yield pa.RecordBatch.from_pydict({"_f": pa.array([x for x, _ in out], pa.string()), "_at": pa.array([s for _, s in out], pa.int64())})


def first_places(lines: DataFrame, starts: DataFrame, between: str) -> DataFrame:
    """(_f, _at): the first line in which each distinct text ``_f`` begins, wherever in the line and over line ends.

    ``lines`` are (seq, text).  A start meets the chunks of text that have the rarer of its first and last grams, and only these are searched; so neither
    is every start held against every line nor are starts sent to all workers, only a filter of bounded size.  Grams are as long as the start
    allows, as those of a few letters (given names) stand in every chunk.  In one task pass only the beginnings of chunks.
    """
    key = ["letters", "gram"]
    wanted = cut(starts.select("_f").distinct().mapInArrow(_start_grams, "_f string, letters int, gram bigint"))
    grams = sorted(r[0] for r in wanted.select("letters").distinct().collect())
    longest = wanted.agg(F.max(F.length("_f"))).first()[0] or 0
    name = _ship_filter(wanted)
    chunks = cut(lines.repartitionByRange("seq").sortWithinPartitions("seq").mapInArrow(lambda it: _chunks(it, between), "chunk bigint, text string, places array<int>, seqs array<bigint>"))
    heads = chunks.select("chunk", F.substring("text", 1, longest).alias("head")).coalesce(1).sortWithinPartitions(F.desc("chunk"))
    chunks = chunks.join(heads.mapInArrow(lambda it: _following(it, longest), "chunk bigint, after string"), "chunk")
    held = chunks.select("chunk", "text", "after").mapInArrow(lambda it: _text_grams(it, grams, name), "letters int, gram bigint, chunk bigint")
    held = cut(held.join(wanted.select(*key).distinct(), key, "left_semi"))
    seen = wanted.join(held.groupBy(*key).agg(F.count("*").alias("n")), key, "left")
    rarest = seen.groupBy("_f").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), *key)).alias("r")).where("r.n > 0").select("_f", "r.letters", "r.gram")
    met = held.join(rarest, key).groupBy("chunk").agg(F.collect_list("_f").alias("starts"))
    return chunks.join(met, "chunk").mapInArrow(_find, "_f string, _at bigint").groupBy("_f").agg(F.min("_at").alias("_at"))


def locate_starts(lines: DataFrame, starts: DataFrame, key: str, seq: str, text: str = "text", flexible: bool = False) -> DataFrame:
    """Where each start text stands first, and in which form: as written, else wrongly decoded once, else twice; as a part of a line or over line ends.

    ``flexible`` lets runs of blanks match one another.
    """
    form = (lambda c: F.regexp_replace(F.trim(c), r"\s+", " ")) if flexible else (lambda c: c)
    start = T.strip(F.col("start"))
    garbled = starts.where(start != "").select(key, start.alias("_0")).withColumn("_1", T.garble_whole("_0")).withColumn("_2", T.garble_whole("_1"))
    a = cut(garbled.select(key, *[form(F.col(c)).alias(c) for c in ("_0", "_1", "_2")]))
    b = lines.where(F.col(text).isNotNull()).select(F.col(seq).cast("bigint").alias("seq"), form(F.col(text)).alias("text"))
    places = cut(first_places(b.where("text <> ''") if flexible else b, a.select(F.explode(F.array("_0", "_1", "_2")).alias("_f")).where("_f <> ''"), " " if flexible else "\n"))
    for c in ("_0", "_1", "_2"):
        a = a.join(places.select(F.col("_f").alias(c), F.col("_at").alias(f"_at{c}")), c, "left")
    found = F.when(F.col("_at_0").isNotNull(), F.col("_0")).when(F.col("_at_1").isNotNull(), F.col("_1")).when(F.col("_at_2").isNotNull(), F.col("_2"))
    return a.select(key, F.coalesce("_at_0", "_at_1", "_at_2").cast(lines.schema[seq].dataType).alias(seq), found.alias("found"))


def untagged(starts: DataFrame, lines: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Starts without those whose mark stands in the text already."""
    marks = lines.select(F.explode(F.regexp_extract_all(F.col(text), F.lit(r'schuttenr="(\d+)"'), F.lit(1))).alias("_nr")).select(F.col("_nr").try_cast("bigint").alias("_nr")).distinct()
    return starts.join(marks, F.col(key) == F.col("_nr"), "left_anti")
