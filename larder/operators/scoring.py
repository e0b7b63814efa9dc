"""Recommendation score.

All corpus-wide figures (prior, bounds) are one-row scalar subqueries, so a base row is never
sent through an unpartitioned window and nothing but the sentiment join is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from larder import constants as K
from larder.functions import numeric, text

RATING_PLACES = 6


def stage_recipes(silver: DataFrame) -> DataFrame:
    """Typed projection of reviewed recipes."""
    return reviewed(silver).select(
        F.col("recipeid").cast("long").alias("recipeid"),
        F.col("name").cast("string").alias("name"),
        F.col("recipecategory").cast("string").alias("recipecategory"),
        F.col("recipeingredientparts").cast("string").alias("recipeingredientparts"),
        F.col("recipeinstructions").cast("string").alias("recipeinstructions"),
        F.col("aggregatedrating").cast("double").alias("aggregatedrating"),
        F.col("reviewcount").cast("long").alias("reviewcount"),
        F.col("totaltime").cast("long").alias("totaltime"),
    )


def stage_sentiment(sentiment: DataFrame) -> DataFrame:
    return sentiment.select(
        F.col("recipeid").cast("long").alias("recipeid"),
        F.col("sentiment_percentile").cast("double").alias("sentiment_percentile"),
    )


def reviewed(recipes: DataFrame) -> DataFrame:
    return recipes.where(F.col("reviewcount") > 0)


def rating_prior(recipes: DataFrame) -> DataFrame:
    """One row ``(prior_mean, prior_weight)``.

    ``percentile`` is exact and keeps one buffer entry per distinct review count; those are
    whole numbers, so the buffer grows with the largest count and not with the rows.
    """
    return recipes.agg(
        numeric.exact_mean(F.col("aggregatedrating"), RATING_PLACES).alias("prior_mean"),
        F.percentile(F.col("reviewcount").cast("double"), K.PRIOR_QUANTILE).alias("prior_weight"),
    )


def with_prior(recipes: DataFrame) -> DataFrame:
    prior = rating_prior(recipes).select(F.struct("prior_mean", "prior_weight")).scalar()
    return recipes.withColumn("prior", prior)


def shrink(value: Column, count: Column, weight: Column, centre: Column) -> Column:
    """Mean of ``value`` and ``centre`` weighted by ``count`` and ``weight``."""
    total = count + weight
    return count / total * value + weight / total * centre


def score_recipes(
    recipes: DataFrame, sentiment: DataFrame, round_inputs: bool = False
) -> DataFrame:
    """Composite score of every reviewed recipe.

    ``round_inputs`` rounds the weighted rating and the shrunk sentiment before they are used,
    as a row-wise implementation of the same formula does; otherwise only the output is rounded.
    """
    count = F.col("reviewcount").cast("double")
    weight = F.col("prior.prior_weight")
    rated = with_prior(reviewed(recipes)).withColumn(
        "weighted", shrink(F.col("aggregatedrating"), count, weight, F.col("prior.prior_mean"))
    )
    if round_inputs:
        rated = rated.withColumn("weighted", numeric.round_half_up(F.col("weighted"), 4))
    scaled = numeric.min_max_columns(rated, ["weighted", "reviewcount", "totaltime"])
    joined = scaled.join(
        sentiment.select("recipeid", F.col("sentiment_percentile").alias("_percentile")),
        "recipeid",
        "left",
    ).withColumn(
        "sentiment_percentile", F.coalesce("_percentile", F.lit(K.NEUTRAL_SENTIMENT))
    )
    joined = joined.withColumn(
        "shrunk",
        shrink(F.col("sentiment_percentile"), count, weight, F.lit(K.NEUTRAL_SENTIMENT)),
    )
    if round_inputs:
        joined = joined.withColumn("shrunk", numeric.round_half_up(F.col("shrunk"), 2))
    simplicity = F.lit(1.0) - F.col("totaltime_scaled")
    composite = (
        F.lit(K.WEIGHT_RATING) * F.col("weighted_scaled")
        + F.lit(K.WEIGHT_SENTIMENT) * (F.col("shrunk") / F.lit(100.0))
        + F.lit(K.WEIGHT_POPULARITY) * F.col("reviewcount_scaled")
        + F.lit(K.WEIGHT_SIMPLICITY) * simplicity
    )
    return joined.select(
        "recipeid",
        "name",
        "recipecategory",
        "recipeingredientparts",
        "recipeinstructions",
        "totaltime",
        text.word_count(F.col("recipeingredientparts")).alias("ingredient_count"),
        "aggregatedrating",
        F.col("reviewcount").cast("long").alias("reviewcount"),
        numeric.round_half_up(F.col("weighted"), 4).alias("weighted_rating"),
        "sentiment_percentile",
        numeric.round_half_up(F.col("shrunk"), 2).alias("shrunk_sentiment"),
        F.col("weighted_scaled").alias("rating_score"),
        F.col("reviewcount_scaled").alias("popularity_score"),
        simplicity.alias("simplicity_score"),
        numeric.round_half_up(composite * F.lit(100.0), 2).alias("appeal_score"),
    )


def ranked(df: DataFrame, score: str, key: str = "recipeid") -> DataFrame:
    """Global order by score, nulls last, ties by key; for sinks only."""
    return df.orderBy(F.col(score).desc_nulls_last(), F.col(key))


def top(df: DataFrame, score: str, rows: int, key: str = "recipeid") -> DataFrame:
    """First rows by score: a bounded heap per task, no full sort."""
    return ranked(df, score, key).limit(rows)
