"""Sustainability score of recipes for every country and month.

Months travel as a 12-bit mask and as sums of two months each, so the large intermediate result has one
row per recipe, term and country; the twelve months are unfolded only in the output.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from larder import constants as K
from larder.functions import numeric, text
from larder.sources.staging import stage
from larder.sources.writers import spread_keys

SHARE_PLACES = 12
#: Rows (recipe, country) that one task sums or writes, whatever the number of recipes.
ROWS_PER_TASK = 150_000
MONTH_NUMBERS = tuple(range(1, 13))
PAIRED_MONTHS = MONTH_NUMBERS[::2]


def seasonality_reference(season: DataFrame) -> DataFrame:
    """Distinct in-season products of every country and month with score 1."""
    return (
        season.where(F.col("is_in_season"))
        .select(F.lower("country").alias("country"), "month_number", "product_name")
        .distinct()
        .withColumn("seasonality_score", F.lit(1.0))
    )


def availability_reference(production: DataFrame) -> DataFrame:
    """Min-max share of production within the latest year of each country.

    The latest year and its bounds come from two small aggregations, not from a window over a
    country, which may hold a large part of all rows.
    """
    rows = production.select(
        F.lower("country_name").alias("country"),
        "product_name",
        "year",
        F.col("item_code") if "item_code" in production.columns else F.lit(0).alias("item_code"),
        F.coalesce("production_value", F.lit(0.0)).alias("value"),
    )
    per_year = rows.groupBy("country", "year").agg(
        F.min("value").alias("low"), F.max("value").alias("high")
    )
    latest = stage(
        per_year.groupBy("country").agg(F.max(F.struct("year", "low", "high")).alias("l")).select(
            "country", "l.*"
        ),
        "latest-year",
    )
    share = numeric.min_max(F.col("value"), F.col("low"), F.col("high"))
    return (
        rows.join(latest, ["country", "year"])
        .groupBy("country", "product_name")
        .agg(F.min_by(share, F.struct("item_code", "value")).alias("availability_score"))
    )


def prepare_matches(matches: DataFrame) -> DataFrame:
    return (
        matches.where(F.col("matched_term").isNotNull() & (F.col("source") != K.UNMATCHED))
        .select("recipeid", "matched_term")
        .distinct()
    )


def recipe_terms(matches: DataFrame) -> DataFrame:
    """Coverage and distinct matched terms per recipe, in one aggregation.

    The sets are bounded by the length of one recipe's text.
    """
    known = F.col("matched_term").isNotNull() & (F.col("source") != K.UNMATCHED)
    grouped = matches.groupBy("recipeid").agg(
        F.size(F.collect_set("ingredient_token")).cast("long").alias("total_ingredient_tokens"),
        F.count("matched_term").alias("matched_ingredient_tokens"),
        F.collect_set(F.when(known, F.col("matched_term"))).alias("terms"),
    )
    share = F.try_divide(
        F.col("matched_ingredient_tokens").cast("double"),
        F.col("total_ingredient_tokens").cast("double"),
    )
    return grouped.withColumn(
        "coverage_score",
        numeric.round_half_up(F.coalesce(share, F.lit(0.0)) * F.lit(100.0), 2),
    )


def coverage(matches: DataFrame) -> DataFrame:
    return recipe_terms(matches).drop("terms")


def countries_array(season: DataFrame) -> Column:
    """Sorted country keys as one array value; the set of countries is small by nature."""
    keys = season.where(F.col("country").isNotNull()).select(F.lower("country").alias("country"))
    return keys.agg(F.array_sort(F.collect_set("country"))).scalar()


def term_contexts(
    terms: DataFrame, season: DataFrame, production: DataFrame, month: int | None = None
) -> DataFrame:
    """Rows (matched_term, country, months, availability) for every term and country.

    ``months`` is a bit mask, of the one wanted month if given. Each term gets a row for each country, also without data, so the
    join to recipes yields every country.
    """
    seasons = season.where(F.col("is_in_season")).select(
        F.lower("country").alias("country"),
        F.col("product_name").alias("matched_term"),
        F.col("month_number"),
    )
    if month is not None:
        seasons = seasons.where(F.col("month_number") == month)
    masks = seasons.groupBy("country", "matched_term").agg(
        F.bit_or(F.expr("cast(shiftleft(1, cast(month_number - 1 as int)) as int)")).alias("months")
    )
    available = availability_reference(production).withColumnRenamed(
        "product_name", "matched_term"
    )
    grid = terms.select("matched_term").withColumn("country", F.explode(countries_array(season)))
    return (
        grid.join(masks, ["country", "matched_term"], "left")
        .join(available, ["country", "matched_term"], "left")
        .select(
            "matched_term",
            "country",
            F.coalesce("months", F.lit(0)).alias("months"),
            F.coalesce("availability_score", F.lit(0.0)).alias("availability_score"),
        )
    )


def in_month(months: Column, month: int) -> Column:
    return months.bitwiseAND(F.lit(1 << (month - 1))) != 0


def paired(months: Column, month: int) -> Column:
    """One long for a month and the next: their bits of the mask as a 1 in its lower and upper 32 bits.

    A recipe has fewer than 2^31 terms, the length of an array, so the sum of neither reaches the other.
    """
    low, high = (F.shiftright(months, m - 1).bitwiseAND(F.lit(1)).cast("long") for m in (month, month + 1))
    return low.bitwiseOR(F.shiftleft(high, 32))


def unpaired(kind: str, month: int) -> Column:
    """The sum of one month out of the sum that it shares."""
    if month % 2:
        return F.col(f"{kind}{month}_{month + 1}").bitwiseAND(F.lit((1 << 32) - 1))
    return F.shiftright(F.col(f"{kind}{month - 1}_{month}"), 32)


def ingredient_scores(contexts: DataFrame) -> DataFrame:
    """Score of each term for each country and month."""
    month = F.explode(F.array(*[
        F.struct(
            F.lit(m).alias("score_month"),
            F.when(in_month(F.col("months"), m), 1.0).otherwise(0.0).alias("seasonality_score"),
        )
        for m in MONTH_NUMBERS
    ]))
    score = (
        F.lit(K.WEIGHT_SEASON) * F.col("seasonality_score")
        + F.lit(K.WEIGHT_AVAILABILITY) * F.col("availability_score")
    )
    return (
        contexts.select("matched_term", "country", "availability_score", month.alias("m"))
        .select(
            "matched_term", F.col("country").alias("score_country"), "m.*", "availability_score"
        )
        .withColumn("ingredient_score", score)
        .withColumn("is_positive", F.col("ingredient_score") > 0)
    )


def recipe_countries(recipes: DataFrame, contexts: DataFrame) -> DataFrame:
    """Sums per recipe and country: availability, and per month seasonal and positive terms.

    Two months share a sum (see ``paired``), which halves what is added up, exchanged and written.
    """
    rows = recipes.where(F.size("terms") > 0).select(
        "recipeid",
        "total_ingredient_tokens",
        "matched_ingredient_tokens",
        "coverage_score",
        F.size("terms").cast("long").alias("recognized_ingredient_count"),
        F.explode("terms").alias("matched_term"),
    ).join(contexts, "matched_term")
    months = F.coalesce("months", F.lit(0))
    positive = F.col("availability_score") > 0
    # All recipe figures ride along as aggregates of equal values, so the grouping key stays
    # (recipeid, country) and the rows of one recipe are combined before any exchange.
    keep = (
        "total_ingredient_tokens", "matched_ingredient_tokens", "coverage_score",
        "recognized_ingredient_count",
    )
    sums = [
        F.sum(numeric.scaled_long(F.col("availability_score"), SHARE_PLACES)).alias("available")
    ]
    for m in PAIRED_MONTHS:
        seasonal = paired(months, m)
        sums.append(F.sum(seasonal).alias(f"s{m}_{m + 1}"))
        sums.append(F.sum(F.when(positive, F.lit((1 << 32) + 1)).otherwise(seasonal)).alias(f"p{m}_{m + 1}"))
    return rows.groupBy("recipeid", "country").agg(
        *[F.max(c).alias(c) for c in keep], *sums
    )


def score_contexts(
    per_country: DataFrame, months: tuple[int, ...] = MONTH_NUMBERS, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Final metrics, one row per recipe, country and month; columns in ``keep`` stay beside them."""
    unfolded = per_country.withColumn(
        "m",
        F.explode(F.array(*[
            F.struct(
                F.lit(m).alias("month"),
                unpaired("s", m).alias("seasonal"),
                unpaired("p", m).alias("positive"),
            )
            for m in months
        ])),
    )
    n = F.col("recognized_ingredient_count").cast("double")
    available = F.col("available") / F.lit(float(10**SHARE_PLACES))
    seasonal = F.col("m.seasonal").cast("double")
    mean = (
        F.lit(K.WEIGHT_SEASON) * seasonal + F.lit(K.WEIGHT_AVAILABILITY) * available
    ) / n * F.lit(100.0)
    bonus = F.when(
        F.col("m.positive") * 3 >= F.col("recognized_ingredient_count") * 2,
        F.lit(K.POSITIVE_BONUS),
    ).otherwise(F.lit(0.0))

    def percent(value: Column) -> Column:
        return numeric.round_half_up(value / n * F.lit(100.0), 2)

    return unfolded.select(
        "recipeid",
        F.col("country").alias("score_country"),
        F.col("m.month").alias("score_month"),
        "recognized_ingredient_count",
        "total_ingredient_tokens",
        "matched_ingredient_tokens",
        percent(seasonal).alias("seasonality_score"),
        percent(available).alias("availability_score"),
        numeric.round_half_up(mean, 2).alias("sustainability_mean"),
        percent(F.col("m.positive").cast("double")).alias("positive_ratio"),
        numeric.round_half_up(F.least(mean + bonus, F.lit(100.0)), 2).alias(
            "sustainability_score"
        ),
        "coverage_score",
        *keep,
    )


def folded_scores(
    matches: DataFrame, season: DataFrame, production: DataFrame, country: str | None = None,
    month: int | None = None, spread_countries: bool = False,
) -> DataFrame:
    """Sums of all recipes with a recognised term, one row per recipe and country, for ``score_contexts``.

    A recipe becomes a row for every country, so the number of tasks follows from these rows and not
    from the few bytes of the recipes. ``spread_countries`` distributes the result for a write by
    country, before the months are unfolded.
    """
    recipes = stage(recipe_terms(matches), "recipe-terms")
    terms = (
        matches.where(F.col("matched_term").isNotNull() & (F.col("source") != K.UNMATCHED))
        .select("matched_term")
        .distinct()
    )
    if country is not None:
        # One context: both sources are cut down at their scans.
        key = text.country_key(F.lit(country))
        season = season.where(text.country_key(F.col("country")) == key)
        production = production.where(text.country_key(F.col("country_name")) == key)
    contexts = stage(term_contexts(terms, season, production, month), "term-contexts")
    countries = sorted(row.country for row in contexts.select("country").distinct().collect())
    scored = recipes.where(F.size("terms") > 0).count()
    parallelism = matches.sparkSession.sparkContext.defaultParallelism
    tasks = max(parallelism, math.ceil(scored * len(countries) / ROWS_PER_TASK))
    sums = recipe_countries(recipes.repartition(tasks, "recipeid"), contexts)
    if spread_countries and countries:
        sums = spread_keys(sums, "country", countries, ("recipeid",), math.ceil(scored / ROWS_PER_TASK))
    return sums


def sustainability_scores(
    matches: DataFrame, season: DataFrame, production: DataFrame, country: str | None = None,
    month: int | None = None, spread_countries: bool = False,
) -> DataFrame:
    """Scores of all recipes with a recognised term, for one or for all contexts.

    ``spread_countries`` distributes the result for a write by country. It moves the rows
    before the months are unfolded, which is a twelfth of the output.
    """
    sums = folded_scores(matches, season, production, country, month, spread_countries)
    return score_contexts(sums, MONTH_NUMBERS if month is None else (month,))
