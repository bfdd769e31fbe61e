import hashlib

import numpy as np

from contractlens.llm import pivot_clusters as pc

SCHEMA = "vec_id long, embedding array<float>, label int, x long, d string, cluster string, distance string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, None, None, None, None, None) for i, v in rows], SCHEMA)


def brute(rows, k, rounds, dim, scale):
    kept = [(i, [int(np.floor(scale * float(np.float32(x)))) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centres = [v for _, v in order[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))
    for _ in range(rounds):
        groups = [[v for _, v in kept if near(v)[1] == n] for n in range(len(centres))]
        centres = [[sum(col) // len(g) for col in zip(*g)] if g else c for g, c in zip(groups, centres)]
    got = [(i, *near(v)[::-1]) for i, v in kept]
    inertia = [sum(d for _, c, d in got if c == n) for n in range(len(centres))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, c, d, inertia[c], sum(inertia), sha[c]) for i, c, d in got), key=str)


def check(spark, rows, **how):
    full = {"k": 16, "rounds": 3, "dim": 8, "scale": 64} | how
    got = pc.cluster(frame(spark, rows), full["k"], full["rounds"], dim=full["dim"], scale=full["scale"])
    assert got.dtypes == [tuple(f.split()) if " " in f else f for f in ("vec_id bigint", "cluster int", "distance bigint", "cluster_inertia bigint", "inertia bigint", "centroid_sha256 string")]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, **full)


def test_matches_brute_force(spark):
    rng = np.random.default_rng(4)
    middles = rng.normal(size=(9, 8)) * 2
    rows = [(i, (middles[i % 9] + rng.normal(size=8) * 0.3).astype(np.float32).tolist()) for i in range(600)]
    rows += [(1000 + i, rows[3][1]) for i in range(200)]  # a large group of equal vectors
    rows += [(5, rows[5][1]), (5, rows[6][1]), (None, rows[7][1]), (None, None), (2001, [None] * 8), (2002, [float("nan")] * 8)]
    rows += [(2003, [float("-inf")] + [0.0] * 7), (2004, [1.0] * 7), (2005, []), (2006, [0.0] * 8)]
    check(spark, rows)


def test_ties_and_empty_clusters(spark):
    # whole-number lattice: many equal distances; equal seeds leave the larger number empty
    rows = [(i, [float(i % 3), float(i // 3 % 3), 0.0, 0.0, 0.0, 0.0, 0.0, 0.0]) for i in range(90)]
    check(spark, rows, scale=1)
    check(spark, [(i, [1.0] * 8) for i in range(30)])


def test_few_or_no_rows(spark):
    check(spark, [])
    check(spark, [(1, [1.0] * 8)])
    check(spark, [(None, [1.0] * 8), (3, [-0.01] * 8)])
    assert pc.cluster(frame(spark, [(1, [1.0] * 8)])).count() == 0  # no vector of 64 components


def test_bounds_drop_no_nearest_centroid():
    rng = np.random.default_rng(6)
    x = rng.integers(-300, 300, (2000, 16))
    centres, pivots = x[:12] + rng.integers(-3, 3, (12, 16)), x[20:25]
    d = np.sqrt(np.stack([pc.squared(x, p) for p in pivots], 1).astype(float))
    every = np.stack([pc.squared(x, c) for c in centres], 1)
    cluster, best = pc.nearest(x, d, centres, pivots)
    assert (cluster == every.argmin(1)).all() and (best == every.min(1)).all()
