import pytest
from pyspark.sql import functions as F

from conftest import plan
from larder.operators import quality, scoring

SCHEMA = (
    "recipeid long, name string, recipecategory string, recipeingredientparts string, "
    "recipeinstructions string, totaltime long, aggregatedrating double, reviewcount double"
)


def recipes(spark, rows):
    return spark.createDataFrame(
        [(i, f"r{i}", "main", "a b  c", "x", t, r, v) for i, t, r, v in rows], SCHEMA
    )


def sentiment(spark, rows):
    return spark.createDataFrame(rows, "recipeid long, sentiment_percentile double")


def reference(rows, percentiles, round_inputs=False):
    """The formula row by row in plain Python."""
    import numpy as np

    rows = [r for r in rows if r[3] > 0]
    mean = sum(r[2] for r in rows) / len(rows)
    m = float(np.quantile([r[3] for r in rows], 0.8))
    weighted = [v / (v + m) * r + m / (v + m) * mean for _, _, r, v in rows]
    shrunk = [
        v / (v + m) * percentiles.get(i, 50.0) + m / (v + m) * 50.0 for i, _, _, v in rows
    ]
    if round_inputs:
        weighted, shrunk = [round(w, 4) for w in weighted], [round(s, 2) for s in shrunk]

    def norm(values):
        known = [x for x in values if x is not None]
        lo, hi = min(known), max(known)
        return [None if x is None else 0.0 if hi == lo else (x - lo) / (hi - lo) for x in values]

    w, p, t = norm(weighted), norm([r[3] for r in rows]), norm([r[1] for r in rows])
    out = {}
    for k, row in enumerate(rows):
        out[row[0]] = (
            None if t[k] is None else
            round(100 * (0.35 * w[k] + 0.25 * shrunk[k] / 100 + 0.2 * p[k] + 0.2 * (1 - t[k])), 2)
        )
    return out


ROWS = [(1, 30, 4.5, 10.0), (2, 60, 3.0, 2.0), (3, 90, 5.0, 40.0), (4, 5, 1.0, 0.0), (5, None, 4.0, 7.0)]


@pytest.mark.parametrize("round_inputs", [False, True])
def test_composite(spark, round_inputs):
    scored = scoring.score_recipes(
        recipes(spark, ROWS), sentiment(spark, [(1, 80.0), (3, 20.0)]), round_inputs
    )
    got = {r.recipeid: r.appeal_score for r in scored.collect()}
    expected = reference(ROWS, {1: 80.0, 3: 20.0}, round_inputs)
    assert got.keys() == expected.keys()
    for key, value in expected.items():
        assert got[key] is None if value is None else got[key] == pytest.approx(value, abs=0.011)


def test_published_examples(spark):
    row = spark.range(1).select(
        scoring.shrink(F.lit(5.0), F.lit(2.0), F.lit(5.0), F.lit(4.5354)).alias("a"),
        scoring.shrink(F.lit(5.0), F.lit(3063.0), F.lit(5.0), F.lit(4.5354)).alias("b"),
        scoring.shrink(F.lit(99.0), F.lit(2.0), F.lit(5.0), F.lit(50.0)).alias("c"),
        scoring.shrink(F.lit(29.79), F.lit(3063.0), F.lit(5.0), F.lit(50.0)).alias("d"),
    ).first()
    assert [round(x, 4) for x in row] == [4.6681, 4.9992, 64.0, 29.8229]


def test_constant_columns_score_zero_or_one(spark):
    rows = [(1, 10, 4.0, 3.0), (2, 10, 4.0, 3.0)]
    got = scoring.score_recipes(recipes(spark, rows), sentiment(spark, [(1, 50.0)])).collect()
    assert {(r.rating_score, r.popularity_score, r.simplicity_score) for r in got} == {(0.0, 0.0, 1.0)}
    assert {r.ingredient_count for r in got} == {3}


def test_top_is_a_heap_and_null_comes_last(spark):
    df = spark.createDataFrame([(1, None), (2, 5.0), (3, 7.0), (4, 7.0)], "recipeid long, s double")
    best = scoring.top(df, "s", 3)
    assert [r.recipeid for r in best.collect()] == [3, 4, 2]
    assert "TakeOrderedAndProject" in plan(best)


def test_no_unpartitioned_window(spark):
    text = plan(scoring.score_recipes(recipes(spark, ROWS), sentiment(spark, [(1, 1.0)])))
    assert "Window" not in text and "CartesianProduct" not in text and "NestedLoop" not in text
    assert "Python" not in text


def test_reconcile(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0)], "k int, s double")
    b = spark.createDataFrame([(1, 1.0), (2, 2.01), (4, 3.0)], "k int, s double")
    row = quality.reconcile(a, b, "k", "s").first()
    assert tuple(row) == (2, 1, 50.0, 0.01, 1, 1)
