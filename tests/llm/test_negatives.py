import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, place string, rank int, kept string"


def brute(rows, positives=5, k=10):
    usable = [
        (i, l, [int(np.floor(256.0 * float(np.float32(c)))) for c in v])
        for i, v, l, *_ in rows
        if i is not None and l is not None and v is not None and None not in v and np.isfinite(v).all()
    ]
    out = []
    anchors = {}
    for i, l, x in usable:
        if i % 100 == 0:
            anchors[i] = min(anchors.get(i, (x, l)), (x, l))
    for a, (x, label) in anchors.items():
        scored = [(-sum(p * q for p, q in zip(x, y)), i, l) for i, l, y in usable if i != a and len(y) == len(x)]
        for p, i, _ in sorted(s for s in scored if s[2] == label)[:positives]:
            hard = sorted(s for s in scored if s[2] != label and 30 * -p <= 100 * -s[0] <= 90 * -p)[:k]
            out += [(a, i, r, n, -p, -s) for r, (s, n, _) in enumerate(hard, 1)]
    return sorted(out)


def got(spark, rows, **more):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(map(tuple, negatives.mine(df, F.col("label"), F.col("vec_id") % 100 == 0, **more).collect()))


def vectors(n, seed, dim=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dim)) * 0.3
    labels = rng.integers(5, size=n)
    x = centres[labels] + rng.normal(size=(n, dim)) * 0.4
    return [(i, [float(c) for c in np.float32(v)], int(l), "p", 1, "k") for i, (v, l) in enumerate(zip(x, labels))]


def test_against_brute_force_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 150)
    monkeypatch.setattr(negatives, "BLOCK_ANCHORS", 4)
    rows = vectors(1200, 3)
    rows[300:360] = [(i, *rows[300][1:]) for i in range(300, 360)]  # ties
    want = brute(rows)
    assert len(want) > 300 and got(spark, rows) == want


def test_hot_label_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 60)
    rows = [(i, v, 0 if i % 2 else l, *rest) for i, v, l, *rest in vectors(500, 4)]
    rows += [(i, *rows[7][1:]) for i in range(600, 900)]  # one vector as more than a third of all rows
    assert got(spark, rows) == brute(rows)


def test_unusable_rows_and_lengths(spark):
    rows = vectors(220, 5)
    rows += [
        (1000, None, 1, "", 1, ""), (1100, rows[0][1], None, "", 1, ""), (None, rows[0][1], 1, "", 1, ""),
        (1200, [1.0, None], 1, "", 1, ""), (1300, [float("nan")] * 8, 1, "", 1, ""), (1400, [float("-inf")] * 8, 1, "", 1, ""),
        (1500, [1.0, 0.5], 1, "", 1, ""), (1501, [0.9, 0.5], 1, "", 1, ""), (1502, [0.2, 0.5], 2, "", 1, ""),
        (1600, [], 1, "", 1, ""), (1601, [], 1, "", 1, ""), (1602, [], 2, "", 1, ""),
    ]
    want = brute(rows)
    assert {r[0] for r in want} >= {1500, 1600} and (1600, 1601, 1, 1602, 0, 0) in want
    assert got(spark, rows) == want


def test_few_and_no_rows(spark):
    assert got(spark, []) == []
    assert got(spark, [(0, [1.0], 1, "", 1, ""), (1, [0.5], 2, "", 1, "")]) == []
    assert got(spark, [(0, [1.0], 1, "", 1, ""), (1, [1.0], 1, "", 1, ""), (2, [0.5], 2, "", 1, "")]) == [(0, 1, 1, 2, 65536, 32768)]


def test_windows_at_their_limits(spark):
    p = spark.createDataFrame([(0, i, s) for i, s in enumerate([100, 0, -5, 7, 1, 11])], "anchor_id long, positive_id long, positive_score long")
    assert {r.positive_score: (r["from"], r["to"]) for r in negatives.windows(p, 30, 90).collect()} == {100: (30, 90), 0: (0, 0), 7: (3, 6), 11: (4, 9)}


def test_slots_hold_the_best_of_each():
    rows = negatives.pd.DataFrame({"id": range(40), "label": [1] * 40, "dim": 1, "x": [[i] for i in range(40)]})
    anchor = negatives.pd.DataFrame({"id": [99], "label": [0], "x": [[1]], "limits": [[30, 20, 5]], "lowest": [2]})
    found = list(negatives._slots(rows, anchor, 3))
    assert found == [(99, 0, 30, 30), (99, 0, 29, 29), (99, 0, 28, 28), (99, 1, 20, 20), (99, 1, 19, 19), (99, 1, 18, 18), (99, 2, 5, 5), (99, 2, 4, 4), (99, 2, 3, 3)]


@pytest.mark.parametrize("size", [10, 2**40])
def test_products_stay_exact(size):
    rng = np.random.default_rng(1)
    a, b = (rng.integers(-size, size, (3, 5)) for _ in range(2))
    want = [[min(max(sum(int(p) * int(q) for p, q in zip(x, y)), -(2**63 - 1)), 2**63 - 1) for y in b] for x in a]
    assert negatives.scores(a, b).tolist() == want
