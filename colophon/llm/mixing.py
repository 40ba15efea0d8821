"""Mixing sources to target weights (problem 8).

The size of a mix is the largest total that every source which is present can serve within its cap: T = min over sources of
``max_repeats * tokens / share``, shares taken over the sources present.  A document of source s is then expected
``f = share * T / tokens`` times: ``floor(f)`` times for certain, and once more with probability ``f - floor(f)``.  These fractions
are rounded by the cube method: three undecided documents at a time move along the null space of the two balancing equations
(number of documents, tokens) until one of them is decided.

The flight runs on blocks of bounded size, each leaving at most two documents undecided; the undecided ones of many blocks form
the blocks of the next round, until one block a source is left, and its last documents land on the rounding nearest to balance.
No step holds more than a block, whatever the size of a source.

Defined results: a source without documents or tokens gives nothing, and the other shares are scaled to sum to one; null
``max_repeats`` counts as 1; documents without tokens are used ``floor(f)`` times and balance only the number of documents;
repeated rows of a key count once.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colophon.llm import tokens
from colophon.session import cut

BLOCK = 4096
_ZERO = 1e-9
_FLIGHT = "mix_name string, source string, doc_id bigint, n_tokens bigint, p double, n bigint"


def flight(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Move the fractions to 0 or 1, keeping their sum and their size-weighted sum; at most two stay undecided."""
    p = p.astype(float).copy()
    open_: list[int] = []
    todo = iter(np.flatnonzero((p > _ZERO) & (p < 1 - _ZERO)).tolist())
    draws, at = rng.random(len(p) + 1), 0
    while True:
        while len(open_) < 3 and (k := next(todo, None)) is not None:
            open_.append(k)
        if len(open_) < 3:
            return p
        i, j, k = open_
        a, b, c = float(size[i]), float(size[j]), float(size[k])
        u = (c - b, a - c, b - a)
        if not any(u):
            u = (1.0, -1.0, 0.0)
        up = down = math.inf
        for x, v in zip(open_, u):
            if v > 0:
                up, down = min(up, (1 - p[x]) / v), min(down, p[x] / v)
            elif v < 0:
                up, down = min(up, -p[x] / v), min(down, -(1 - p[x]) / v)
        step = up if draws[at % len(draws)] * (up + down) < down else -down
        at += 1
        for x, v in zip(open_, u):
            p[x] += step * v
        open_ = [x for x in open_ if _ZERO < p[x] < 1 - _ZERO]


def land(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Round the few fractions that are left so that tokens, then documents, stay nearest to balance.

    Where the nearest rounding is still off, one chosen document is exchanged for one that was not, if that comes nearer.
    """
    p = p.copy()
    left = np.flatnonzero((p > _ZERO) & (p < 1 - _ZERO))
    goal = (float((p[left] * size[left]).sum()), float(p[left].sum()))
    best = min(range(1 << len(left)), key=lambda m: (abs(sum(float(size[x]) for n, x in enumerate(left) if m >> n & 1) - goal[0]), abs(bin(m).count("1") - goal[1]), m))
    for n, x in enumerate(left):
        p[x] = best >> n & 1
    p = np.round(p)
    off = sum(float(size[x]) for n, x in enumerate(left) if best >> n & 1) - goal[0]
    inside, outside = np.flatnonzero(p == 1), np.flatnonzero(p == 0)
    if off and len(inside) and len(outside):
        outside = outside[np.argsort(size[outside], kind="stable")]
        wanted = size[inside] - off
        at = np.clip(np.searchsorted(size[outside], wanted), 0, len(outside) - 1)
        at = np.where((at > 0) & (np.abs(size[outside[np.maximum(at - 1, 0)]] - wanted) < np.abs(size[outside[at]] - wanted)), at - 1, at)
        miss = np.abs(size[outside[at]] - wanted)
        if miss.min() < abs(off):
            k = int(miss.argmin())
            p[inside[k]], p[outside[at[k]]] = 0, 1
    return p


def _round(block: int, seed: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("doc_id", kind="stable")
        size = rows["n_tokens"].to_numpy()
        rng = np.random.default_rng([seed, *(sum(map(ord, str(k))) for k in key)])
        # larger documents first: those that stay undecided are small
        order = np.argsort(-size, kind="stable")
        p = np.empty(len(rows))
        p[order] = flight(rows["p"].to_numpy()[order], size[order], rng)
        blocks = -(-int(rows["n"].iloc[0]) // block)
        # blocks are hashed, hence uneven; each leaves two at most
        return rows.assign(p=p if blocks > 1 else land(p, size), n=2 * blocks)[["mix_name", "source", "doc_id", "n_tokens", "p", "n"]]

    return run


def sized_documents(docs: DataFrame, vocab: str = "byte_bpe_50k.tiktoken", folder: str | None = None) -> DataFrame:
    """doc_id, source and n_tokens, once a document, kept in the shared folder for the passes that follow."""
    counted = tokens.count_tokens(docs.select("doc_id", "source", "text"), ["doc_id", "source"], vocab=vocab, folder=folder)
    return cut(counted.where("doc_id is not null and source is not null").groupBy("doc_id").agg(F.min("source").alias("source"), F.max("n_tokens").alias("n_tokens")))


def plan(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per mix and source: what is there, the share aimed at, and the expected uses ``f`` of a document."""
    have = sized.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("tokens"))
    # one row per mix and source, however large the corpus
    wanted = targets.where("mix_name is not null and source is not null").groupBy("mix_name", "source").agg(F.max("target_share").alias("target_share"), F.max(F.coalesce("max_repeats", F.lit(1))).alias("max_repeats"))
    rows = wanted.join(have, "source", "left").withColumns({"n_docs": F.coalesce("n_docs", F.lit(0)), "tokens": F.coalesce("tokens", F.lit(0))})
    rows = rows.withColumn("usable", (F.col("tokens") > 0) & (F.col("target_share") > 0) & (F.col("max_repeats") > 0))
    per_mix = rows.where("usable").groupBy("mix_name").agg(F.sum("target_share").alias("present"))
    rows = rows.join(per_mix, "mix_name", "left").withColumn("share", F.when(F.col("usable"), F.col("target_share") / F.col("present")).otherwise(0.0))
    total = rows.where("usable").groupBy("mix_name").agg(F.min(F.col("max_repeats") * F.col("tokens") / F.col("share")).alias("total"))
    f = F.when(F.col("usable"), F.least(F.col("share") * F.col("total") / F.col("tokens"), F.col("max_repeats").cast("double"))).otherwise(0.0)
    return rows.join(total, "mix_name", "left").withColumn("f", f).drop("present")


def mix(sized: DataFrame, targets: DataFrame, seed: int = 7, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """The uses of every document in every mix, and the plan they follow."""
    goal = cut(plan(sized, targets))
    largest = goal.agg(F.max("n_docs")).first()[0] or 0
    rows = sized.join(F.broadcast(goal.where("usable").select("mix_name", "source", "f", F.col("n_docs").alias("n"))), "source")
    base = F.floor(F.col("f") + F.lit(_ZERO)).cast("int")
    rows = rows.withColumn("base", base).withColumn("p", F.greatest(F.col("f") - F.col("base"), F.lit(0.0)))
    whole = rows.where(f"p <= {_ZERO}")
    open_ = rows.where(f"p > {_ZERO}").select("mix_name", "source", "doc_id", "n_tokens", "p", "n")
    decided, left, n = [], open_, largest
    while True:
        # every source has blocks of its own number, and lands in the round in which it is one block
        blocks = F.greatest(F.ceil(F.col("n") / block), F.lit(1))
        out = left.withColumn("block", F.pmod(F.xxhash64("doc_id", "n"), blocks)).groupBy("mix_name", "source", "block").applyInPandas(_round(block, seed), _FLIGHT)
        if n <= block:
            decided.append(out)
            break
        out = cut(out)
        decided.append(out.where(f"p <= {_ZERO} or p >= 1 - {_ZERO}"))
        left, n = out.where(f"p > {_ZERO} and p < 1 - {_ZERO}"), 2 * math.ceil(n / block)
    extra = decided[0]
    for part in decided[1:]:
        extra = extra.unionByName(part)
    extra = extra.join(F.broadcast(goal.select("mix_name", "source", "f")), ["mix_name", "source"]).withColumn("copies", (F.floor(F.col("f") + F.lit(_ZERO)) + F.round("p")).cast("int"))
    uses = whole.select("mix_name", "source", "doc_id", "n_tokens", F.col("base").alias("copies")).unionByName(extra.select("mix_name", "source", "doc_id", "n_tokens", "copies"))
    return uses.where("copies > 0"), goal


def shares(uses: DataFrame, goal: DataFrame) -> DataFrame:
    """Target and reached share of every source of every mix."""
    got = uses.groupBy("mix_name", "source").agg(F.count("*").alias("docs_used"), F.max("copies").alias("most_copies"), F.sum(F.col("copies") * F.col("n_tokens")).alias("tokens_used"))
    whole = got.groupBy("mix_name").agg(F.sum("tokens_used").alias("mix_tokens"))
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("docs_used", "most_copies", "tokens_used")}
    return (
        goal.join(got, ["mix_name", "source"], "left").join(whole, "mix_name", "left").withColumns(zero)
        .select("mix_name", "source", "target_share", "share", "max_repeats", "n_docs", "tokens", "docs_used", "most_copies", "tokens_used", F.coalesce(F.col("tokens_used") / F.col("mix_tokens"), F.lit(0.0)).alias("reached_share"), F.when(F.col("usable"), "mixed").otherwise("absent").alias("state"))
    )
