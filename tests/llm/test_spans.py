import random

from colophon.llm import spans


def brute(docs, length):
    """Every window by its text."""
    seen = {}
    for i, t in docs:
        for s in range(len(t or "") - length + 1):
            seen.setdefault(t[s : s + length], set()).add(i)
    out = set()
    for i, t in docs:
        flags = [False] * (len(t or "") + 1)
        for s in range(len(t or "") - length + 1):
            if len(seen[t[s : s + length]]) > 1:
                flags[s : s + length] = [True] * length
        start = None
        for p, f in enumerate(flags):
            if f and start is None:
                start = p
            elif not f and start is not None:
                out.add((i, start, p))
                start = None
    return sorted(out)


def run(spark, docs, length, gram, shard=spans.SHARD):
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    return sorted(tuple(r) for r in spans.shared_spans(df, length, gram, shard).collect())


def test_automaton_against_all_substrings():
    rng = random.Random(4)
    for _ in range(150):
        texts = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 25))) for _ in range(rng.randrange(1, 6))]
        docs = [rng.randrange(4) for _ in texts]
        automaton = spans.SuffixAutomaton()
        for t, d in zip(texts, docs):
            automaton.add(t, d, d)
        automaton.close()
        for t, d in zip(texts, docs):
            others = [x for x, e in zip(texts, docs) if e != d]
            want = [max((n for n in range(1, e + 1) if any(t[e - n : e] in o for o in others)), default=0) for e in range(1, len(t) + 1)]
            assert list(automaton.matches(t, d)) == want


def test_against_every_window(spark):
    for seed in range(4):
        rng = random.Random(seed)
        pieces = ["".join(rng.choice("ab ") for _ in range(rng.randrange(5, 60))) for _ in range(12)] + ["é" * 50, "xyz" * 30]
        docs = [(i, "".join(rng.choice(pieces)[rng.randrange(4) :] for _ in range(rng.randrange(9)))) for i in range(40)]
        docs += [(100, None), (101, ""), (102, docs[3][1]), (103, docs[3][1]), (3, docs[3][1])]
        for shard in (2, 64):
            assert run(spark, docs, 24, 12, shard) == brute(docs, 24), (seed, shard)


def test_segments_and_empty_table(spark, monkeypatch):
    rng = random.Random(9)
    base = "".join(rng.choice("abcdefgh") for _ in range(3000))
    docs = [(1, base), (2, base[700:1900] + "zz"), (3, "q" + base[2500:] + base[:40])]
    whole = run(spark, docs, 200, 100)
    assert whole == brute(docs, 200)
    texts = [t for _, t in docs] + [None, "short"]
    seen = {}
    for size in (257, 1 << 20):
        monkeypatch.setattr(spans, "SEGMENT", size)
        found = [(int(k), int(a + s), int(h)) for g in spans.groups(texts, 200, 100) for k, f, l, s, h in zip(g.text, g.first, g.last, g.shift, g.h) for a in range(f, l + 1)]
        seen[size] = sorted(set(found))
    assert seen[257] == seen[1 << 20] and len(seen[257]) == sum(len(t) - 199 for _, t in docs)
    assert run(spark, [], 200, 100) == []
