"""Sentiment of recipes kept up by batches of new, changed and withdrawn reviews.

A store is a folder of versions. Each holds what its batch changed: the scores of its reviews, signed
counts and sums for the recipes it touches, and the histogram of all recipe means, which has at most
10,001 rows. A batch scores its own texts only and looks up its own reviews and recipes; sums are whole
numbers, so any row of batches equals one build of all reviews. A version counts once its row in
``versions`` is written, last of all: a batch that failed half way is run again over its own remains.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from larder.functions import numeric
from larder.operators.sentiment import SentimentRules, score_reviews

PLACES = 2
TABLES = {
    "scores": "reviewid long, recipeid long, units long",
    "moments": "recipeid long, n long, s1 decimal(38,0), s2 decimal(38,0)",
    "histogram": "units long, recipes long",
    "versions": "since long",
}


def _write(df: DataFrame, store: str, table: str, version: int) -> None:
    df.write.mode("overwrite").parquet(f"{store}/{table}/version={version}")


def _read(spark: SparkSession, store: str, table: str) -> DataFrame:
    return spark.read.schema(f"{TABLES[table]}, version long").parquet(f"{store}/{table}")


def create(spark: SparkSession, store: str) -> None:
    """An empty store; one in the same place is an error."""
    for table in ("scores", "moments", "histogram"):
        empty = spark.createDataFrame([], TABLES[table])
        empty.write.mode("errorifexists").parquet(f"{store}/{table}/version=0")
    _write(spark.range(1).select(F.lit(0).cast("long").alias("since")), store, "versions", 0)


def latest(spark: SparkSession, store: str) -> tuple[int, int]:
    """The newest whole version, and the first one that its tables are the sum of."""
    found = _read(spark, store, "versions").agg(F.max(F.struct("version", "since")).alias("v")).first()["v"]
    return found["version"], found["since"]


def _upto(spark: SparkSession, store: str, table: str, span: tuple[int, int]) -> DataFrame:
    newest, since = span
    return _read(spark, store, table).where(F.col("version").between(since, newest))


def _summed(moments: DataFrame) -> DataFrame:
    """(recipeid, n, s1, s2) of recipes; those without a review left stay with n = 0."""
    sums = [F.sum(c).cast(t).alias(c) for c, t in (("n", "long"), ("s1", "decimal(38,0)"), ("s2", "decimal(38,0)"))]
    return moments.groupBy("recipeid").agg(*sums)


def _current(scores: DataFrame) -> DataFrame:
    """(reviewid, recipeid, units): the newest row of each review, null units if it was withdrawn."""
    newest = scores.groupBy("reviewid").agg(F.max_by(F.struct("recipeid", "units"), "version").alias("at"))
    return newest.select("reviewid", "at.recipeid", "at.units")


def _signed(scores: DataFrame, sign: int) -> DataFrame:
    wide = F.col("units").cast("decimal(19,0)")
    return scores.where("units is not null").select(
        "recipeid",
        F.lit(sign).cast("long").alias("n"),
        (wide * sign).cast("decimal(38,0)").alias("s1"),
        (wide * wide * sign).cast("decimal(38,0)").alias("s2"),
    )


def _mean(n: Column, s1: Column) -> Column:
    """The mean score to two decimals; null without a review."""
    mean = F.try_divide(s1.cast("double"), n) / F.lit(float(10**PLACES))
    return numeric.round_half_up(mean, PLACES)


def apply_batch(
    store: str, batch: DataFrame, lexicon: DataFrame, rules: SentimentRules = SentimentRules()
) -> int:
    """Take in ``batch`` (reviewid, recipeid, review, withdrawn) and return the new version.

    A review id stands once in a batch and is not null. A known id replaces its earlier review, also
    under another recipe; a withdrawn one takes it back, and does nothing where the id is unknown.
    Null ``withdrawn`` counts as false. A null recipe is a recipe of its own.
    """
    spark = batch.sparkSession
    span = latest(spark, store)
    version, since = span[0] + 1, span[1]
    gone = F.coalesce(F.col("withdrawn"), F.lit(False))
    scored = score_reviews(batch.where(~gone), lexicon, rules).select(
        "reviewid", "recipeid", numeric.scaled_long(F.col("sentiment_score"), PLACES).alias("units")
    )
    none = F.lit(None).cast("long")
    rows = scored.unionByName(batch.where(gone).select("reviewid", none.alias("recipeid"), none.alias("units")))
    _write(rows, store, "scores", version)

    new = _read(spark, store, "scores").where(F.col("version") == version)
    known = _upto(spark, store, "scores", span).join(new.select("reviewid"), "reviewid", "left_semi")
    _write(_summed(_signed(new, 1).unionByName(_signed(_current(known), -1))), store, "moments", version)

    change = _read(spark, store, "moments").where(F.col("version") == version).drop("version")
    touched = change.select(F.col("recipeid").alias("_touched"))
    before = _upto(spark, store, "moments", span).join(
        touched, F.col("recipeid").eqNullSafe(F.col("_touched")), "left_semi"
    )
    labelled = before.drop("version").withColumn("old", F.lit(1)).unionByName(change.withColumn("old", F.lit(0)))
    old = lambda c: F.sum(F.when(F.col("old") == 1, F.col(c)))
    means = labelled.groupBy("recipeid").agg(
        _mean(old("n"), old("s1")).alias("was"), _mean(F.sum("n"), F.sum("s1")).alias("is")
    )
    moves = F.array(
        F.struct(numeric.scaled_long(F.col("was"), PLACES).alias("units"), F.lit(-1).cast("long").alias("recipes")),
        F.struct(numeric.scaled_long(F.col("is"), PLACES).alias("units"), F.lit(1).cast("long").alias("recipes")),
    )
    moved = means.select(F.inline(moves)).where("units is not null")
    held = _read(spark, store, "histogram").where(F.col("version") == span[0]).drop("version")
    counts = held.unionByName(moved).groupBy("units").agg(F.sum("recipes").alias("recipes")).where("recipes <> 0")
    _write(counts, store, "histogram", version)
    _write(spark.range(1).select(F.lit(since).alias("since")), store, "versions", version)
    return version


def compact(spark: SparkSession, store: str) -> int:
    """A version that holds the sum of all before it, so that readers need no older one."""
    span = latest(spark, store)
    version = span[0] + 1
    _write(_current(_upto(spark, store, "scores", span)).where("units is not null"), store, "scores", version)
    _write(_summed(_upto(spark, store, "moments", span)).where("n <> 0"), store, "moments", version)
    held = _read(spark, store, "histogram").where(F.col("version") == span[0]).drop("version")
    _write(held, store, "histogram", version)
    _write(spark.range(1).select(F.lit(version).alias("since")), store, "versions", version)
    return version


def recipe_sentiment(spark: SparkSession, store: str) -> DataFrame:
    """The rows of ``aggregate_by_recipe`` with their ``sentiment_percentile``, from the state alone.

    Ranks come from the histogram, so no recipe is sorted.
    """
    span = latest(spark, store)
    n, s1, s2 = F.col("n"), F.col("s1"), F.col("s2")
    rows = _summed(_upto(spark, store, "moments", span)).where("n <> 0").select(
        "recipeid",
        _mean(n, s1).alias("mean_sentiment_score"),
        n.alias("review_count"),
        F.coalesce(numeric.round_half_up(numeric.moments_stddev(n, s1, s2, PLACES), PLACES), F.lit(0.0)).alias(
            "std_sentiment"
        ),
    )
    held = _read(spark, store, "histogram").where(F.col("version") == span[0])
    total = F.sum("recipes").over(W.orderBy("units").rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    ranks = held.withColumn("total", total).withColumn("upto", F.sum("recipes").over(W.orderBy("units")))
    rank = F.col("upto") - F.col("recipes") + (F.col("recipes") + 1) / F.lit(2.0)
    percentile = numeric.round_half_up(rank / F.col("total") * F.lit(100.0), 2).alias("sentiment_percentile")
    key = numeric.scaled_long(F.col("mean_sentiment_score"), PLACES)
    # A histogram has at most one row for each of 10,001 means.
    joined = rows.withColumn("units", key).join(F.broadcast(ranks.select("units", percentile)), "units", "left")
    return joined.drop("units")
