import math

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.sql import functions as F

from larder import constants as K
from larder.operators import kmeans, segments

COLUMNS = ["x", "y"]


@pytest.fixture(scope="module")
def points(spark):
    rows = [(i, (i % 3) * 10 + (i % 7) * 0.1, (i % 3) * 5 + (i % 5) * 0.1) for i in range(90)]
    return spark.createDataFrame(rows, "recipeid long, x double, y double")


def test_clusters_and_distances(points):
    got = segments.cluster(points, COLUMNS, k=3, starts=2).collect()
    assert {r.cluster_id for r in got} == {0, 1, 2} and len(got) == 90
    centers = {}
    for c in range(3):
        mine = [r for r in got if r.cluster_id == c]
        centers[c] = (sum(r.x for r in mine) / len(mine), sum(r.y for r in mine) / len(mine))
    for r in got:
        to = {c: math.dist((r.x, r.y), p) for c, p in centers.items()}
        assert r.distance_to_centroid == pytest.approx(to[r.cluster_id], abs=1e-9)
        assert to[r.cluster_id] == min(to.values())


def test_elbow_falls(points):
    rows = segments.elbow(points, COLUMNS, starts=2).orderBy("k").collect()
    assert [r.k for r in rows] == list(K.ELBOW_RANGE)
    assert rows[0].inertia > rows[1].inertia >= rows[-1].inertia


def test_silhouette(points):
    labelled = segments.cluster(points, COLUMNS, k=3, starts=3)
    assert segments.silhouette(labelled, COLUMNS).first()[0] > 0.9


def cloud(spark, n=300, seed=5):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 2)) + rng.integers(4, size=(n, 1)) * 2.5
    return x, spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "recipeid long, x double, y double").repartition(5)


def lloyd(x, centers, table=None):
    """Centres of the points, at rest by the spread of the whole table."""
    limit = kmeans.TOLERANCE * (x if table is None else table).var(axis=0).mean()
    while True:
        gap = ((x[:, None] - centers) ** 2).sum(axis=2)
        own = gap.argmin(axis=1)
        moved = np.array([x[own == i].mean(axis=0) if (own == i).any() else centers[i] for i in range(len(centers))])
        if ((moved - centers) ** 2).sum() <= limit:
            return moved, ((x[:, None] - moved) ** 2).sum(axis=2).min(axis=1).sum()
        centers = moved


def test_shared_passes_give_the_fits_of_single_ones(spark, monkeypatch):
    x, df = cloud(spark)
    monkeypatch.setattr(kmeans, "SEED_ROWS", 60)
    passes = []
    plain = kmeans.sums_by_center
    monkeypatch.setattr(kmeans, "sums_by_center", lambda *a: passes.append(len(a[2])) or plain(*a))
    settings = [(k, s) for k in (2, 3, 5) for s in range(4)]
    fits = kmeans.fit_all(df, COLUMNS, settings)
    points = kmeans.seed_rows(kmeans.complete_rows(df, COLUMNS), COLUMNS)
    for f in fits:
        centers, cost = lloyd(x, lloyd(points, kmeans.plus_plus(points, f.k, f.seed), x)[0])
        np.testing.assert_allclose(f.centers, centers, atol=1e-9)
        assert f.cost == pytest.approx(cost)
    # As many passes as the slowest fit and one for the costs; fits that rest drop out.
    assert len(passes) == max(f.passes for f in fits) + 1 and passes == [*sorted(passes[:-1], reverse=True), 12]


def test_costs_are_not_above_those_of_the_library(spark):
    _, df = cloud(spark, seed=6)
    vectors = segments.as_vectors(df, COLUMNS)
    theirs = min(KMeans(k=4, seed=s, maxIter=300, tol=1e-4).fit(vectors).summary.trainingCost for s in range(5))
    assert min(f.cost for f in kmeans.fit_all(df, COLUMNS, [(4, s) for s in range(10)])) <= theirs * 1.0001


def test_missing_values_and_few_rows(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 1.0, 1.0), (3, None, 1.0), (4, float("nan"), 0.0)], "recipeid long, x double, y double")
    got = {r.recipeid: (r.cluster_id, r.distance_to_centroid) for r in segments.cluster(df, COLUMNS, k=5, starts=2).collect()}
    assert got[3] == got[4] == (None, None) and got[1][0] != got[2][0] and got[1][1] == got[2][1] == 0.0
    empty = segments.cluster(df.limit(0), COLUMNS).collect()
    assert empty == [] and {r.inertia for r in segments.elbow(df.limit(0), COLUMNS, starts=1).collect()} == {0.0}


def test_euclidean_silhouette(spark):
    x, df = cloud(spark, n=120)
    labels = (x.sum(axis=1) > 3).astype(int) + (x.sum(axis=1) > 8)
    rows = [(i, float(a), float(b), int(l)) for i, ((a, b), l) in enumerate(zip(x, labels))] + [(900, 50.0, 50.0, 7), (901, None, 0.0, 1), (902, 0.0, 0.0, None)]
    df = spark.createDataFrame(rows, "recipeid long, x double, y double, cluster_id int")
    used = [(np.array([a, b]), l) for _, a, b, l in rows if a is not None and l is not None]
    scores = []
    for i, (p, l) in enumerate(used):
        by = {}
        for j, (q, m) in enumerate(used):
            if i != j:
                by.setdefault(m, []).append(float(np.linalg.norm(p - q)))
        inside, outside = np.mean(by.pop(l, [0.0])), min(map(np.mean, by.values()))
        alone = sum(m == l for _, m in used) == 1
        scores.append(0.0 if alone else (outside - inside) / max(inside, outside))
    assert segments.euclidean_silhouette(df, COLUMNS).first()[0] == pytest.approx(np.mean(scores))
    part = segments.euclidean_silhouette(df, COLUMNS, sample=80).first()[0]
    assert abs(part - np.mean(scores)) < 0.15
    assert segments.euclidean_silhouette(df.where("cluster_id = 1"), COLUMNS).first()[0] is None


def profiles(spark):
    features = list(K.SEGMENT_FEATURES)
    rows = []
    for c in range(5):
        row = {f: 0.1 for f in features}
        row["cluster_id"] = c
        row["recipe_count"] = 1
        rows.append(row)
    rows[2]["rating_score"] = 0.9
    rows[2]["eufic_match_count"] = 0.9
    rows[4]["eufic_match_count"] = 0.5
    rows[0]["sentiment_percentile"] = rows[1]["sentiment_percentile"] = 0.7
    rows[3]["totaltime_inverted"] = 0.8
    schema = ", ".join(f"{f} double" for f in features) + ", cluster_id int, recipe_count int"
    return spark.createDataFrame([tuple(r[f] for f in features) + (r["cluster_id"], 1) for r in rows], schema)


def test_labels_are_greedy_and_unique(spark):
    got = {r.cluster_id: r.cluster_label for r in segments.label_profiles(profiles(spark)).collect()}
    assert got == {
        2: "🏆 Top Rated", 4: "🌿 Seasonal & Local", 0: "⭐ Crowd Favourite", 3: "⚡ Quick & Easy", 1: "🌍 Global Kitchen",
    }


def test_fewer_clusters_than_labels(spark):
    two = profiles(spark).where("cluster_id in (2, 4)")
    got = {r.cluster_id: r.cluster_label for r in segments.label_profiles(two).collect()}
    assert got == {2: "🏆 Top Rated", 4: "🌿 Seasonal & Local"}


def test_clip_fill_invert(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(101)] + [(200, None)], "recipeid long, totaltime double")
    clipped = segments.clip_upper(df, "totaltime", 0.9)
    assert clipped.agg(F.max("totaltime")).first()[0] == 90.0
    assert clipped.where("totaltime is null").count() == 1
    filled = segments.fill_median(clipped, ["totaltime"])
    assert filled.where("recipeid = 200").first().totaltime == 50.0
    inverted = segments.invert(filled, "totaltime", "t")
    assert inverted.agg(F.min("t"), F.max("t")).first() == (0.0, 90.0)


def test_features_are_scaled(spark):
    rows = [(i, float(i), float(i), 0.5, i % 3, i * 10, float(i) / 9) for i in range(10)] + [(99, None, None, None, None, None, None)]
    schema = ("recipeid long, appeal_score double, sentiment_percentile double, simplicity_score double, "
              "eufic_match_count long, totaltime long, rating_score double")
    got = segments.build_features(spark.createDataFrame(rows, schema)).collect()
    for name in K.SEGMENT_FEATURES:
        values = [getattr(r, name) for r in got]
        assert min(values) >= 0 and max(values) <= 1 and None not in values
    assert {r.simplicity_score for r in got} == {0.0}
