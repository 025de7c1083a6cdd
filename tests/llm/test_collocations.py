"""Collocations against plain counting, and the lockstep reading over cut ranges."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hourmill.llm.collocations import PhraseSpec, collocations, with_heads

PIECE, WORD = re.compile(r"[.,;:!?\x0A-\x0D]"), re.compile(r"[^\x20\x09]+")


def brute(rows, spec=None):
    spec = spec or PhraseSpec()
    counts, totals, out = Counter(), Counter(), []
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in PIECE.split(low):
            w = WORD.findall(piece)
            totals[lang] += len(w)
            for m in range(1, spec.words + 1):
                counts.update((lang, tuple(w[i : i + m])) for i in range(len(w) - m + 1))
    candidates = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= spec.least}
    gone = set()
    for (lang, p), a in candidates.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                part = (lang, p[i : i + m])
                if 100 * a >= spec.nested * counts[part]:
                    gone.add(part)
    for lang in totals:
        ranked = []
        for (own, p), a in candidates.items():
            if own == lang and (own, p) not in gone:
                cuts = [(10**6 * a * a // (counts[own, p[:k]] * counts[own, p[k:]]), k, counts[own, p[:k]], counts[own, p[k:]]) for k in range(1, len(p))]
                score, _, left, right = min(cuts)
                ranked.append((-score, -a, " ".join(p).encode(), left, right))
        ranked.sort()
        out += [(lang, n + 1, p.decode(), -a, left, right, totals[lang], -s) for n, (s, a, p, left, right) in enumerate(ranked[: spec.keep])]
    return sorted(out)


def prose(rng, n, words):
    return "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", ";", " !"]) for _ in range(n))


@pytest.mark.parametrize("spec", [PhraseSpec(), PhraseSpec(slice_bytes=500, keep=7), PhraseSpec(words=4, least=3, nested=70)])
def test_against_brute_force(spark, spec):
    rng = random.Random(3)
    words = ["a", "B", "b", "C", "cc", "new", "York", "york", "city", "été", "日本", "x\x1cy", "und", "in", "the"]
    rows = [(prose(rng, rng.randint(0, 60), words[: rng.choice([4, 15])]), rng.choice(["en", "fr", None, "und"])) for _ in range(120)]
    rows += [(None, "en"), ("", None), (" \n", "de"), ("New York City " * 30, "en"), (prose(rng, 20000, words), "fr"), ("tie one. tie two. " * 12, "xx")]
    rows += rows[:10]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(6)
    for c in ("words", "n", "f", "order", "heads", "phrase", "total"):
        docs = docs.withColumn(c, F.lit(1))
    got = collocations(docs, spec)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, spec)
    assert collocations(docs.limit(0), spec).collect() == []


def test_large_counts_are_exact(spark):
    """Products beyond 64 bits, by the reading of a made-up stream."""
    rows = [("en", ["a"], 1, 9 * 10**14 + 7), ("en", ["a", "b"], 2, 8 * 10**14 + 3), ("en", ["b"], 1, 10**15 + 9)]
    stream = spark.createDataFrame(rows, "lang string, words array<string>, n int, f long")
    left = with_heads(stream, F.col("words"), "lefts", 1)
    both = with_heads(left, F.reverse("words"), "rights", 1).filter("n = 2").first()
    assert (both.lefts, both.rights) == ([rows[0][3]], [rows[2][3]])


def test_heads_cross_ranges(spark):
    """One first word whose extensions fill many ranges."""
    rows = [("en", ["a"], 1, 10**6)] + [("en", [f"w{i:04}"], 1, 1000 + i) for i in range(300)]
    rows += [("en", ["a", f"w{i:04}"], 2, 100 + i) for i in range(300)]
    rows += [("en", ["a", f"w{i:04}", "z"], 3, 10 + i) for i in range(300)] + [("fr", ["a"], 1, 5), ("fr", ["a", "b"], 2, 4), ("fr", ["b"], 1, 4)]
    stream = spark.createDataFrame(rows, "lang string, words array<string>, n int, f long").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for order, cut in ((F.col("words"), lambda w, k: w[:k]), (F.reverse("words"), lambda w, k: w[-k:])):
            own = {(lang, tuple(w)): f for lang, w, _, f in rows}
            found = with_heads(stream, order, "heads", 2)
            assert found.rdd.getNumPartitions() > 4
            for r in found.collect():
                for k in range(1, min(r.n, 2) + 1):
                    part = (r.lang, tuple(cut(r.words, k)))
                    if part in own:
                        assert r.heads[k - 1] == own[part]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
