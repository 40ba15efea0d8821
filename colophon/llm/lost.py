"""Lost characters (U+FFFD) filled in where the corpus still has the word (problem 2).

A wrong decoding that loses characters loses every one outside ASCII, so a damaged word equals an undamaged one with those letters
masked.  Undamaged words are counted under their masked form; the most frequent one fills the gap, and a word that the corpus
has nowhere else keeps its marks.  Damaged words meet the dictionary in a join, as it grows with the names in the corpus.

Defined results: ties go to the word that sorts first; null values stay null; a repeated delivery counts once.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colophon.llm.garbled import FIELDS, LOST
from colophon.session import cut

_WORD = re.compile(f"(?:[^\\W\\d_]|{LOST})+")
_OUTSIDE = re.compile("[^\x00-\x7f]")


def masked(word: str) -> str:
    return _OUTSIDE.sub(LOST, word)


def _whole_words(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Masked form, word and count of the undamaged words that have letters outside ASCII."""
    for batch in it:
        words: Counter = Counter()
        for column in batch.columns:
            for text in column.to_pylist():
                if text and not text.isascii():
                    words.update(w for w in _WORD.findall(text) if not w.isascii() and LOST not in w)
        yield pa.RecordBatch.from_arrays([pa.array([masked(w) for w in words], pa.string()), pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], names=["mask", "word", "n"])


def _damaged_words(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        out = set()
        for key, *values in zip(*(c.to_pylist() for c in batch.columns)):
            out.update((key, masked(w)) for v in values if v and LOST in v for w in _WORD.findall(v) if LOST in w and w.strip(LOST))
        rows = sorted(out, key=repr)
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], names=["id", "mask"])


def fill(text: str | None, words: dict[str, str]) -> str | None:
    """The text with every damaged word replaced that the dictionary knows."""
    if not text or LOST not in text:
        return text
    return _WORD.sub(lambda m: words.get(masked(m.group()), m.group()) if LOST in m.group() else m.group(), text)


def _fill_batches(it: Iterator[pa.RecordBatch], fields: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        known = [{x["mask"]: x["word"] for x in own or []} for own in batch.column(batch.num_columns - 1).to_pylist()]
        done = [pa.array([fill(v, w) for v, w in zip(column.to_pylist(), known)], pa.string()) for column in batch.columns[1:-1]]
        yield pa.RecordBatch.from_arrays([batch.column(0), *done], names=["id", *fields])


def filled_values(restored: DataFrame, key: str = "lemma_id", fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Restored records with their lost characters filled in where that is possible; records without any pass by the joins."""
    # used three times: restored once
    restored = cut(restored)
    damaged = reduce(or_, (F.coalesce(F.instr(f, LOST) > 0, F.lit(False)) for f in fields))
    hurt = restored.where(damaged).select(F.col(key).alias("id"), *fields)
    words = restored.select(*fields).mapInArrow(_whole_words, "mask string, word string, n bigint").groupBy("mask", "word").agg(F.sum("n").alias("n"))
    best = words.groupBy("mask").agg(F.min_by("word", F.struct((-F.col("n")).alias("n"), F.col("word"))).alias("word"))
    need = hurt.mapInArrow(_damaged_words, "id bigint, mask string")
    own = need.where("id is not null").join(best, "mask").groupBy("id").agg(F.collect_list(F.struct("mask", "word")).alias("known"))
    ddl = "id bigint, " + ", ".join(f"`{f}` string" for f in fields)
    full = hurt.join(own, "id", "left").mapInArrow(lambda it: _fill_batches(it, fields), ddl).withColumnRenamed("id", key)
    return restored.where(~damaged).select(key, *fields).unionByName(full)
