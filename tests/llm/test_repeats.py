"""Substring dedup against a brute-force reading of every window."""

import hashlib
import random
from collections import Counter

import pytest

from hourmill.llm.repeats import RepeatSpec, remove_repeats


def brute(rows, length=20):
    """Counter of (doc_id, n_words, n_removed, sha256) for (doc_id, text) rows."""
    order = sorted({(i is None, i or 0, hashlib.md5((t or "").encode()).digest(), t or "") for i, t in rows})
    seen, found = set(), {}
    for null, i, _, t in order:
        words = t.encode().split()
        gone = set()
        for s in range(len(words) - length + 1):
            window = tuple(words[s : s + length])
            if window in seen:
                gone |= set(range(s, s + length))
            seen.add(window)
        kept = [w for n, w in enumerate(words) if n not in gone]
        found[(None if null else i, t)] = (len(words), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest())
    return Counter((i, *found[(i, t or "")]) for i, t in rows)


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    got = remove_repeats(odd_docs)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == brute(rows)
    assert remove_repeats(no_docs).collect() == []


@pytest.mark.parametrize("vocabulary", [2, 60])
def test_against_brute_force(spark, vocabulary):
    rng = random.Random(vocabulary)
    words = [f"w{i}" for i in range(vocabulary)]
    passages = [[rng.choice(words) for _ in range(rng.randint(5, 45))] for _ in range(6)]
    rows = []
    for i in range(70):
        text = []
        while len(text) < rng.choice([0, 10, 30, 120, 300]):
            text += rng.choice(passages) if rng.random() < 0.6 else [rng.choice(words) for _ in range(rng.randint(1, 15))]
        rows.append((i if rng.random() < 0.95 else None, None if rng.random() < 0.05 else rng.choice([" ", "\n"]).join(text)))
    rows += rng.sample(rows, 8) + [(3, "a b"), (3, rows[7][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert Counter(tuple(r) for r in remove_repeats(docs).collect()) == brute(rows)


def test_passages_that_share_only_their_anchor(spark):
    """Two families around the same eight words: the second family's first hub is the first's document."""
    rng = random.Random(1)
    fresh = lambda n: [f"x{rng.random()}" for _ in range(n)]
    heart = ["the", "same", "eight", "words", "are", "in", "all", "documents"]
    families = [fresh(12) + heart + fresh(12) for _ in range(3)]
    rows = [(n, " ".join(fresh(25) + families[n % 3] + fresh(25))) for n in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(tuple(r) for r in remove_repeats(docs).collect())
    assert got == brute(rows)
    assert sorted(r[2] for r in got) == [0] * 3 + [32] * 9


def test_other_lengths(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(60))) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = remove_repeats(docs, RepeatSpec(length=6, seed=3, block=5)).collect()
    assert Counter(tuple(r) for r in got) == brute(rows, 6)
    with pytest.raises(ValueError):
        RepeatSpec(length=5, seed=6)
