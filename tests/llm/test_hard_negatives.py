"""Hard negatives against a full sort of exact scores, and the scan's bounds."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourmill.llm.hard_negatives import NegativeSpec, hard_negatives, scan

SCHEMA = "vec_id long, embedding array<float>, label int, score int, rank int, blk long"


def brute(rows, spec=None):
    spec = spec or NegativeSpec()
    taking = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        own = (label + 1) % spec.labels if i % spec.relabel_step == 0 else label
        taking[i] = (own, [math.floor(256 * float(np.float32(x))) for x in v])
    out = []
    for a, (label, v) in taking.items():
        if a % spec.anchor_step:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), i, own) for i, (own, w) in taking.items() if i != a and len(w) == len(v))
        for p, positive, _ in [s for s in scored if s[2] == label][: spec.positives]:
            window = [(n, i) for n, i, own in scored if own != label and spec.least * -p <= 100 * -n <= spec.most * -p]
            out += [(a, positive, rank + 1, i, -p, -n) for rank, (n, i) in enumerate(window[: spec.negatives])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, 2, 3) for i, v, label in rows], SCHEMA).repartition(5)


@pytest.mark.parametrize("size", [8, 3])
def test_against_brute_force(spark, size):
    rng = random.Random(size)
    # Few values a component: many ties. Odd rows: nulls, NaN, infinities, other lengths, negative scores.
    rows = [(i, [rng.choice([-0.5, -0.1, 0.0, 0.2, 0.7]) for _ in range(size)], rng.randrange(3)) for i in range(400)]
    rows += [(1000, None, 1), (1001, [None] * size, 1), (1002, [float("nan")] * size, 1), (1003, [float("inf")] * size, 1), (1004, [0.1] * size, None)]
    rows += [(1100, [0.3] * (size + 1), 1), (1101, [0.3] * (size + 1), 1), (1102, [0.2] * (size + 1), 2), (1103, [], 1), (None, [0.7] * size, 1)]
    rows += [rows[5], rows[100], (1200, [0.0] * size, 1), (1300, [-0.9] * size, 2)]
    spec = NegativeSpec(block_rows=40, group_rows=2, columns=2)
    got = hard_negatives(frame(spark, rows), spec)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute(rows)
    assert sorted(tuple(r) for r in got.collect()) == want
    assert sorted(tuple(r) for r in hard_negatives(frame(spark, rows)).collect()) == want
    assert {r[0] for r in want} >= {0, 100, 200, 300, 1100}


def test_no_rows_and_large_components(spark):
    assert hard_negatives(frame(spark, [])).collect() == []
    with pytest.raises(Exception, match="too large"):
        hard_negatives(frame(spark, [(1, [1e9, 0.0], 1)])).collect()


def test_two_rows_of_one_id(spark):
    """They are two rows: both anchors, both candidates."""
    rows = [(100, [1.0, 0.0], 1), (100, [0.0, 1.0], 1), (1, [0.5, 0.5], 1), (2, [0.3, 0.2], 2)]
    got = hard_negatives(frame(spark, rows)).filter(F.col("anchor_id") == 100).collect()
    assert sorted({(r.positive_id, r.positive_score, r.negative_score) for r in got}) == [(1, 32768, 256 * 51), (1, 32768, 256 * 76)]


def test_scan_keeps_the_best_of_each_window():
    rng = np.random.default_rng(4)
    block = rng.integers(-200, 200, (16, 500))
    ends = np.stack([block.min(axis=1), block.max(axis=1)])
    for _ in range(20):
        anchor = rng.integers(-200, 200, 16)
        score = anchor @ block
        low, high = sorted(rng.choice(score, 2, replace=False))
        best, got = scan(anchor, block, ends, [low], [high], 5, 3)
        inside = np.sort(score[(score >= low) & (score <= high)])[::-1]
        least = inside[min(5, len(inside)) - 1]
        assert set(best[0]) == set(np.flatnonzero((score >= least) & (score <= high)))
        assert (got[best[0]] == score[best[0]]).all()
