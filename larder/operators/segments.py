"""Recipe segments: scaled features, K-Means, profiles and labels."""

from __future__ import annotations

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F

from larder import constants as K
from larder.functions import numeric
from larder.operators import kmeans
from larder.sources.staging import stage

FEATURES = list(K.SEGMENT_FEATURES)


def feature_join(
    recommendations: DataFrame, sentiment: DataFrame, recipe_map: DataFrame
) -> DataFrame:
    return recommendations.join(
        sentiment.select("recipeid", "mean_sentiment_score"), "recipeid", "left"
    ).join(
        recipe_map.select(
            "recipeid", "eufic_match_count", "faostat_match_count", "unmatched_count"
        ),
        "recipeid",
        "left",
    )


def clip_upper(df: DataFrame, column: str, q: float) -> DataFrame:
    """Values above the exact quantile become the quantile; nulls stay null."""
    cap = numeric.exact_quantile(df, column, q).scalar()
    value = F.col(column).cast("double")
    return df.withColumn("_cap", cap).withColumn(
        column, F.when(value.isNotNull(), F.least(value, F.col("_cap")))
    ).drop("_cap")


def fill_median(df: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls become the exact median of their column; a column of nulls stays null."""
    medians = numeric.exact_quantiles(df, [(name, 0.5) for name in columns])
    rows = df.withColumn("_medians", medians.select(F.struct("*")).scalar())
    filled = {c: F.coalesce(F.col(c).cast("double"), F.col(f"_medians.q{i}")) for i, c in enumerate(columns)}
    return rows.withColumns(filled).drop("_medians")


def invert(df: DataFrame, column: str, target: str) -> DataFrame:
    peak = df.agg(F.max(column)).scalar()
    return df.withColumn(target, peak - F.col(column))


def build_features(joined: DataFrame) -> DataFrame:
    """Recipe id and the six features scaled to [0, 1].

    Standardising before the min-max step does not change its result, so it is left out. All
    quantiles come from one pair of passes; the filled rows are written, since the bounds need them.
    """
    raw = joined.select(
        "recipeid", "appeal_score", "sentiment_percentile", "simplicity_score",
        F.col("eufic_match_count").cast("double").alias("eufic_match_count"),
        "totaltime", "rating_score",
    )
    # A median is never above a quantile beyond it, so clipping first would not change it.
    columns = [c for c in raw.columns if c != "recipeid"]
    wanted = [("totaltime", K.TIME_CLIP_QUANTILE), *[(c, 0.5) for c in columns]]
    figures = numeric.exact_quantiles(raw, wanted).select(F.struct("*")).scalar()
    time = F.col("totaltime").cast("double")
    capped = F.when(time.isNotNull(), F.least(time, F.col("_figures.q0")))
    values = {c: capped if c == "totaltime" else F.col(c).cast("double") for c in columns}
    filled = raw.withColumn("_figures", figures).select(
        "recipeid", *[F.coalesce(values[c], F.col(f"_figures.q{i}")).alias(c) for i, c in enumerate(columns, 1)]
    )
    filled = stage(filled, "filled")
    inverted = invert(filled, "totaltime", "totaltime_inverted").select("recipeid", *FEATURES)
    scaled = numeric.min_max_columns(inverted, FEATURES)
    return scaled.select("recipeid", *[F.col(f"{c}_scaled").alias(c) for c in FEATURES])


def as_vectors(features: DataFrame, columns: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol="features").transform(features)


def fit_best(features: DataFrame, columns: list[str], k: int, seed: int, starts: int) -> kmeans.Fit:
    """Fit with the lowest cost over several seeds."""
    return min(kmeans.fit_all(features, columns, [(k, seed + i) for i in range(starts)]), key=lambda f: f.cost)


def elbow(features: DataFrame, columns: list[str], starts: int = K.SEGMENT_STARTS) -> DataFrame:
    """Rows (k, inertia) for the usual range of k; all fits share their passes over the rows."""
    settings = [(k, K.SEGMENT_SEED + i) for k in K.ELBOW_RANGE for i in range(starts)]
    best: dict[int, float] = {}
    for fit in kmeans.fit_all(features, columns, settings):
        best[fit.k] = min(fit.cost, best.get(fit.k, float("inf")))
    return features.sparkSession.createDataFrame(sorted(best.items()), "k int, inertia double")


def centers_table(spark, centers) -> DataFrame:
    rows = [(i, [float(x) for x in center]) for i, center in enumerate(centers)]
    return spark.createDataFrame(rows, "cluster_id int, center array<double>")


def distances(assigned: DataFrame, centers: DataFrame, columns: list[str]) -> DataFrame:
    """Euclidean distance of each row to the centre of its own cluster (k rows, broadcast)."""
    point = F.array(*[F.col(c).cast("double") for c in columns])
    squares = F.zip_with(point, F.col("center"), lambda a, b: (a - b) * (a - b))
    total = F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x)
    return (
        assigned.join(F.broadcast(centers), "cluster_id")
        .withColumn("distance_to_centroid", F.sqrt(total))
        .drop("center")
    )


def cluster(features: DataFrame, columns: list[str], k: int = K.SEGMENT_COUNT,
            seed: int = K.SEGMENT_SEED, starts: int = K.SEGMENT_STARTS) -> DataFrame:
    """Cluster id and distance for each row; initial centres differ from other libraries."""
    fit = fit_best(features, columns, k, seed, starts)
    return kmeans.nearest(features, columns, fit.centers, "cluster_id", "distance_to_centroid")


def silhouette(labelled: DataFrame, columns: list[str], cluster: str = "cluster_id") -> DataFrame:
    """Silhouette of given labels with squared Euclidean distance over all rows."""
    rows = as_vectors(labelled, columns).select(
        F.col("features"), F.col(cluster).cast("double").alias("prediction")
    )
    score = ClusteringEvaluator(distanceMeasure="squaredEuclidean").evaluate(rows)
    return labelled.sparkSession.createDataFrame(
        [(float(score),)], "silhouette_squared_euclidean double"
    )


def euclidean_silhouette(
    labelled: DataFrame, columns: list[str], cluster: str = "cluster_id", sample: int = K.SILHOUETTE_SAMPLE
) -> DataFrame:
    """Silhouette of given labels with Euclidean distance, over a sample of at most ``sample`` rows."""
    return kmeans.silhouette(labelled, columns, cluster, sample)


def embedding_features(embeddings: DataFrame, size: int) -> DataFrame:
    return embeddings.select(
        "vec_id", *[F.col("embedding")[i].cast("double").alias(f"x{i}") for i in range(size)]
    )


def build_profiles(assigned: DataFrame, columns: list[str] = FEATURES) -> DataFrame:
    """Mean of each feature and size per cluster."""
    return assigned.groupBy("cluster_id").agg(
        *[numeric.exact_mean(F.col(c), 9).alias(c) for c in columns],
        F.count("*").alias("recipe_count"),
    )


def label_profiles(profiles: DataFrame) -> DataFrame:
    """Each label goes to the free cluster that is highest on the label's feature.

    Subtracting the mean over clusters would not change which cluster is highest. The k profile
    rows become one array, from which the winners are picked one after the other.
    """
    features = [feature for _, feature in K.SEGMENT_LABELS]
    picked = profiles.agg(F.collect_list(F.struct("cluster_id", *features)).alias("rows"))
    taken: list[str] = []
    for i, feature in enumerate(features):

        def score(row):
            return F.struct(row[feature].alias("score"), (-row["cluster_id"]).alias("minus_id"))

        def is_free(row):
            free = F.lit(True)
            for winner in taken:
                free = free & ~F.coalesce(row["cluster_id"] == F.col(winner), F.lit(False))
            return free

        best = F.array_max(F.transform(F.filter("rows", is_free), score))
        picked = picked.withColumn(f"winner{i}", -best["minus_id"])
        taken.append(f"winner{i}")
    winners = picked.select(F.struct(*taken)).scalar()
    label = F.lit(K.SEGMENT_FALLBACK)
    for winner, (name, _) in reversed(list(zip(taken, K.SEGMENT_LABELS))):
        label = F.when(F.col("cluster_id") == F.col(f"_winners.{winner}"), F.lit(name)).otherwise(label)
    return (
        profiles.withColumn("_winners", winners)
        .withColumn("cluster_label", label)
        .drop("_winners")
    )


def attach_labels(assigned: DataFrame, labelled: DataFrame) -> DataFrame:
    """Labels joined by cluster id (k rows, broadcast)."""
    side = labelled.select("cluster_id", "cluster_label")
    return assigned.join(F.broadcast(side), "cluster_id", "left")


