import math

import numpy as np
from pyspark.sql import functions as F

from larder.llm import onebit

SCHEMA = "vec_id long, embedding array<float>, score string"


def brute(rows, k):
    out = {}
    usable = [(i, np.array(v, float)) for i, v, _ in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    for i, q in usable:
        if i % 20 == 0:
            near = sorted((-float((v * q).sum()), j) for j, v in usable if j != i and len(v) == len(q))
            out[i] = [(j, -s) for s, j in near[:k]]
    return out


def check(spark, rows, k=20):
    df = spark.createDataFrame(rows, SCHEMA)
    got = {}
    for r in onebit.search(df, F.col("vec_id") % 20 == 0, k).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    return got, {q: x for q, x in brute(rows, k).items() if x}


def test_neighbours_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(onebit, "BLOCK_ROWS", 150)
    monkeypatch.setattr(onebit, "BLOCK_QUERIES", 9)
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(6, 32))
    vectors = centres[rng.integers(6, size=500)] + rng.normal(size=(500, 32)) * rng.uniform(0.05, 1, size=(500, 1))
    vectors = vectors.astype(np.float32)
    vectors[100:160] = vectors[100]  # ties
    rows = [(i, [float(x) for x in v], "clash") for i, v in enumerate(vectors)]
    rows += [(1000, None, ""), (1020, [], ""), (1040, [0.0] * 32, ""), (1060, [float("nan")] * 32, ""), (1080, [1.0, None], ""), (1100, [float("inf")] * 32, ""), (None, rows[0][1], ""), (1120, [1.0, 2.0], ""), (1121, [2.0, 1.0], "")]
    got, want = check(spark, rows)
    assert got.keys() == want.keys()
    hits = sum(len({j for j, _ in got[q]} & {j for j, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) > 0.98
    for q in want:
        truth = dict(want[q])
        assert all(math.isclose(s, truth[j], abs_tol=1e-9) for j, s in got[q] if j in truth)
    assert got[1120] == [(1121, 4.0)] and [j for j, _ in got[100]] == list(range(101, 121))


def test_bounds_hold():
    rng = np.random.default_rng(12)
    vectors, queries = rng.normal(size=(3000, 64)), rng.normal(size=(20, 64))
    turn = onebit.rotation(64, onebit.code_bits(64))
    packed, norms, own = onebit.encode(vectors, turn)
    guess, error = onebit.estimate(packed, own, queries, turn)
    true = (queries / np.linalg.norm(queries, axis=1)[:, None]) @ (vectors / norms[:, None]).T
    assert packed.shape == (3000, 32) and np.mean(np.abs(guess - true) <= error) > 0.999
    assert abs(np.mean(guess - true)) < 0.002


def test_few_and_no_rows(spark):
    got, want = check(spark, [(0, [1.0, 0.0], ""), (1, [0.5, 0.5], ""), (2, [0.5, 0.5], "")])
    assert got == want == {0: [(1, 0.5), (2, 0.5)]}
    assert onebit.search(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 20 == 0).count() == 0
