import numpy as np
import pytest
from pyspark.sql import functions as F

from contractlens.llm import norm_topk as nt

SCHEMA = "vec_id long, embedding array<float>, x long, block int, ids string"


def brute(rows, k):
    whole = {i: np.floor(1024 * np.array(v, np.float32).astype(np.float64)).astype(np.int64) for i, v in rows
             if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    dim = max(map(len, whole.values()), default=0)
    full = {i: np.pad(v, (0, dim - len(v))) for i, v in whole.items()}
    out = []
    for q in (i for i in full if i % 100 == 0):
        best = sorted((-int(full[q] @ v), i) for i, v in full.items() if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, None, None, None) for i, v in rows], SCHEMA)


@pytest.mark.parametrize("block", [64, 4096])
def test_matches_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(nt, "BLOCK_ROWS", block)
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=16) * rng.choice([0.1, 1, 5])).astype(np.float32).tolist()) for i in range(700)]
    rows += [(1000 + i, rows[3][1]) for i in range(40)]  # equal vectors
    rows += [(2000, None), (2001, [None] * 16), (2100, [float("nan")] * 16), (2200, [float("inf")] + [0.0] * 15), (2300, [1.0, 2.0]), (2400, []), (None, [1.0] * 16), (-100, [0.0] * 16)]
    got = sorted(tuple(r) for r in nt.top_k(frame(spark, rows), F.col("vec_id") % 100 == 0, 10).collect())
    assert got == brute(rows, 10)


def test_few_or_no_rows(spark):
    ask = F.col("vec_id") % 100 == 0
    assert nt.top_k(frame(spark, []), ask).count() == 0
    assert nt.top_k(frame(spark, [(0, [1.0, 2.0])]), ask).count() == 0
    assert [tuple(r) for r in nt.top_k(frame(spark, [(0, [1.0]), (1, [2.0]), (2, [-1.0])]), ask).collect()] == [(0, 1, 1, 2 * 1024**2), (0, 2, 2, -(1024**2))]


@pytest.mark.parametrize("block", [2, 4096])
def test_rows_of_one_id_are_queries_and_candidates_of_their_own(spark, monkeypatch, block):
    monkeypatch.setattr(nt, "BLOCK_ROWS", block)
    rows = [(100, [1.0, 0.0]), (100, [0.5, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (7, [0.0, 2.0])]
    unit = 1024**2
    got = sorted(tuple(r) for r in nt.top_k(frame(spark, rows), F.col("vec_id") % 100 == 0, 3).collect())
    first = [(100, 1, 1, unit), (100, 2, 1, unit), (100, 3, 100, unit // 2)]
    second = [(100, 1, 1, unit // 2), (100, 2, 1, unit // 2), (100, 3, 100, unit // 2)]
    assert got == sorted(first + second)


def small_steps(monkeypatch):
    for name, value in (("BLOCK_ROWS", 64), ("QUERY_ROWS", 4), ("TILE", 16), ("ROUND", 3)):
        monkeypatch.setattr(nt, name, value)


@pytest.mark.parametrize("scale", [1, 50, 3e5])
@pytest.mark.parametrize("fall", [1.0, 0.7])
def test_rounds_tiles_heads_and_wide_numbers_match_brute_force(spark, monkeypatch, scale, fall):
    small_steps(monkeypatch)
    rng = np.random.default_rng(2)
    turn = np.linalg.qr(rng.normal(size=(16, 16)))[0]
    vectors = (rng.normal(size=(500, 16)) * fall ** np.arange(16)) @ turn * scale
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(vectors)]
    got = sorted(tuple(r) for r in nt.top_k(frame(spark, rows), F.col("vec_id") % 100 == 0, 10).collect())
    assert got == brute(rows, 10)


def test_crowds_of_equal_vectors_match_brute_force(spark, monkeypatch):
    small_steps(monkeypatch)
    kinds = np.random.default_rng(3).normal(size=(3, 8)).astype(np.float32).tolist()
    rows = [((i * 37) % 500, kinds[i % 3]) for i in range(500)]
    got = sorted(tuple(r) for r in nt.top_k(frame(spark, rows), F.col("vec_id") % 100 == 0, 10).collect())
    assert got == brute(rows, 10)


def test_candidates_go_once_and_queries_only_to_blocks_in_reach(spark):
    vectors = nt.whole_vectors(frame(spark, [(i, [float(8 - i // 2), 0.0]) for i in range(8)]), "vec_id", "embedding")
    blocks = vectors.withColumn("block", (F.col("vec_id") / 2).cast("int"))
    asked = vectors.filter("vec_id in (0, 6)").withColumn("least", F.expr("if(vec_id = 0, 8L * 7 * 1024 * 1024, null)"))
    got = sorted((r.asks, r.key, r.vec_id) for r in nt.pairs_of(blocks, asked, 0, [8192.0, 7168.0, 6144.0, 5120.0], 1).collect())
    assert got == [(0, i // 2, i) for i in range(8)] + [(1, 0, 0), (1, 0, 6), (1, 1, 0), (1, 1, 6), (1, 2, 6), (1, 3, 6)]
