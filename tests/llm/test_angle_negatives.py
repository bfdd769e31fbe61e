import numpy as np
import pytest
from pyspark.sql import functions as F

from contractlens.llm import angle_negatives as an

SCHEMA = "vec_id long, embedding array<float>, label int, x long, block int, row string, score string, rank string, least string, is_anchor string"
ASK = "vec_id % 100 = 0"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, c, *[None] * 7) for i, v, c in rows], SCHEMA)


def brute(rows, positives=5, negatives=10, band=(30, 90)):
    whole = [(i, np.floor(256 * np.array(v, np.float32).astype(np.float64)).astype(np.int64), c) for i, v, c in rows
             if c is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    dim = max((len(v) for _, v, _ in whole), default=0)
    whole = [(i, np.pad(v, (0, dim - len(v))), c) for i, v, c in whole]
    last = lambda i: (i is None, i or 0)
    out = []
    for n, (anchor, a, c) in enumerate(whole):
        if anchor is None or anchor % 100:
            continue
        scored = [(-int(a @ v), last(i), m, i, d == c) for m, (i, v, d) in enumerate(whole) if m != n]
        for s, _, _, positive, _ in sorted(x for x in scored if x[4])[:positives]:
            inside = sorted(x for x in scored if not x[4] and band[0] * -s <= -100 * x[0] <= band[1] * -s)[:negatives]
            out += [(anchor, positive, r + 1, x[3], -s, -x[0]) for r, x in enumerate(inside)]
    return sorted(out, key=str)


def check(spark, rows, **how):
    got = an.mine(frame(spark, rows), F.expr(ASK), **how)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, **how)


def some(seed, many, dim=12, labels=4):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(labels, dim))
    make = lambda i: (middles[i % labels] * rng.choice([0.2, 1, 3]) + rng.normal(size=dim) * rng.choice([0.05, 0.5])).astype(np.float32).tolist()
    return [(i, make(i), int(rng.integers(labels))) for i in range(many)]


@pytest.mark.parametrize("block", [24, 4096])
def test_matches_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(an, "BLOCK_ROWS", block)
    monkeypatch.setattr(an, "ANCHOR_ROWS", 3)
    rows = some(3, 700)
    rows += [(2000 + i, rows[100][1], 1) for i in range(60)]  # a group of equal vectors, some of them anchors
    rows += [(200, rows[7][1], 2), (200, rows[8][1], 2), (None, rows[100][1], 1), (None, rows[9][1], 3)]
    rows += [(3000, None, 1), (3100, rows[1][1], None), (3200, [None] * 12, 1), (3300, [float("nan")] * 12, 1), (3400, [float("inf")] + [0.0] * 11, 0)]
    rows += [(3500, [1.0, -2.0], 1), (3600, [], 2), (3700, [0.0] * 12, 2), (-100, rows[4][1], 0)]
    check(spark, rows)


def test_other_counts_and_band(spark):
    check(spark, some(8, 300), positives=2, negatives=3, band=(10, 110))


def test_few_or_no_rows(spark):
    check(spark, [])
    check(spark, [(0, [1.0, 2.0], 1)])
    check(spark, [(0, [1.0], 1), (1, [2.0], 1), (2, [1.0], 2), (3, [-2.0], 2)])
    check(spark, [(1, [1.0], 1), (2, [2.0], 1)])  # nobody asks
    assert an.mine(frame(spark, [(0, [], 1), (1, [], 2)]), F.expr(ASK)).count() == 0


def test_intervals_hold_every_score():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.integers(-400, 400, (500, 8)), np.zeros((1, 8), np.int64)])
    x = np.concatenate([x, x[:5], -x[:5], 3 * x[:5]])
    length = np.sqrt((x**2).sum(1).astype(float))
    references = np.linalg.qr(rng.normal(size=(8, 5)))[0]
    angles = np.arccos(np.clip(x @ references / np.maximum(length, 1e-300)[:, None], -1, 1))
    narrow = 0
    for n in range(len(x)):
        low, high = an.interval(angles[n], length[n], angles, length)
        score = x @ x[n]
        assert (low <= score).all() and (score <= high).all()
        narrow += (high - low < length * length[n]).sum()
    assert narrow > len(x)


def test_scores_beyond_63_bits_are_an_error(spark):
    with pytest.raises(Exception, match="would not fit"):
        an.mine(frame(spark, [(0, [1e10], 1), (1, [1.0], 1)]), F.expr(ASK)).count()
