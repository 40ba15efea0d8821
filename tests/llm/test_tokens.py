import os
import random

import pytest

from colophon.llm import tokens

PATH = tokens.vocabulary("byte_bpe_50k.tiktoken")
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="no vocabulary files here")
HARD = ["", " ", "  a", "a  b", "\n\n x \n", "  a  b", "don't we'll 'S", "x" * 999, "ab" * 3000, "é" * 777, "漢字 \U0001f600 ½ ²", "a\x1c b\x85c", "<|endoftext|>", "12 34567 (1000001),", "tail  ", "\ttab \t tab"]


@pytest.fixture(scope="module")
def reference():
    import tiktoken
    import public_tokenizers as P

    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=tokens.load_ranks(PATH), special_tokens={})


def brute(piece, ranks):
    """Merge the leftmost pair of lowest rank by looking at all pairs."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, at = min((ranks.get(a + b, 1 << 40), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank == 1 << 40:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def test_segment_tree_merges_like_a_full_scan():
    ranks, rng = tokens.load_ranks(PATH), random.Random(1)
    for _ in range(400):
        piece = bytes(rng.choice(b"abcdeinrst \xc3\xa9") for _ in range(rng.randrange(1, 40)))
        assert tokens.merge(piece, ranks) == brute(piece, ranks)


def test_same_ids_as_the_library(reference):
    rng = random.Random(2)
    texts = HARD + ["".join(rng.choice("ab  \n'1é漢 .,") for _ in range(rng.randrange(80))) for _ in range(500)]
    for t in texts:
        assert tokens.encode(t, PATH) == reference.encode_ordinary(t), repr(t)


def test_both_files_hold_the_same_ranks():
    other = tokens.load_ranks(tokens.vocabulary("byte_bpe_50k.json"))
    assert {k: v for k, v in other.items() if v < 50256} == tokens.load_ranks(PATH)


def test_full_store_changes_nothing(reference, monkeypatch):
    monkeypatch.setattr(tokens, "STORE_LIMIT", 3)
    monkeypatch.setattr(tokens, "_LOADED", {})
    text = " ".join(f"word{i % 9} x" for i in range(200))
    assert tokens.encode(text, PATH) == reference.encode_ordinary(text)


def test_nulls_and_empty_table(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "c")], "doc_id bigint, text string")
    got = sorted(((r.doc_id or 0), list(r.ids)) for r in tokens.encode_corpus(df).collect())
    ab, c = tokens.encode("a b", PATH), tokens.encode("c", PATH)
    assert got == [(0, c), (1, []), (2, []), (3, ab), (3, ab)]
    assert tokens.encode_corpus(df.limit(0)).count() == 0
    counts = {r.doc_id: r.n_tokens for r in tokens.count_tokens(df, ["doc_id"]).collect()}
    assert counts[3] == 2 and counts[1] == 0
