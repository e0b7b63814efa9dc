"""Reports and data checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from larder.functions import numeric
from larder.sources.schemas import require_columns

SCORES = ("seasonality_score", "availability_score", "sustainability_score", "coverage_score")


def _mean(name: str) -> Column:
    return numeric.round_half_up(numeric.exact_mean(F.col(name), 2), 2)


def _means() -> list[Column]:
    return [
        _mean("sustainability_score").alias("mean_score"),
        _mean("seasonality_score").alias("mean_seasonality"),
        _mean("availability_score").alias("mean_availability"),
        _mean("coverage_score").alias("mean_coverage"),
    ]


def global_stats(scores: DataFrame) -> DataFrame:
    """One row over the score table.

    Recipes are counted by themselves, so that no other figure travels with a recipe's id; the rest
    is summed for each of the few months first.
    """
    means = {c: f"mean_{'score' if c == 'sustainability_score' else c.removesuffix('_score')}" for c in SCORES}
    units = {c: numeric.scaled_long(F.col(c), 2) for c in means}
    by_month = scores.groupBy("score_month").agg(
        F.count("*").alias("rows"),
        F.min("sustainability_score").alias("low"),
        F.max("sustainability_score").alias("high"),
        *[numeric.exact_total(u).alias(f"sum_{c}") for c, u in units.items()],
        *[F.count(u).alias(f"n_{c}") for c, u in units.items()],
    )

    def mean(name: str) -> Column:
        total = F.sum(f"sum_{name}").cast("double")
        return numeric.round_half_up(total / F.sum(f"n_{name}") / F.lit(100.0), 2)

    return by_month.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.count("score_month").alias("months"),
        F.min("low").alias("min_score"),
        F.max("high").alias("max_score"),
        *[mean(c).alias(means[c]) for c in ("sustainability_score", "seasonality_score", "availability_score", "coverage_score")],
    ).select(
        "rows", scores.agg(F.count_distinct("recipeid")).scalar().alias("recipes"), "months", "min_score", "max_score",
        "mean_score", "mean_seasonality", "mean_availability", "mean_coverage",
    )


def stats_by_country(scores: DataFrame) -> DataFrame:
    """Figures per country; recipes are counted by themselves, so that no sum travels with their ids."""
    figures = scores.groupBy("score_country").agg(F.count("*").alias("rows"), *_means())
    recipes = (
        scores.select(F.col("score_country").alias("_country"), "recipeid").distinct()
        .groupBy("_country").agg(F.count("recipeid").alias("recipes"))
    )
    joined = figures.join(recipes, F.col("score_country").eqNullSafe(F.col("_country")))
    return joined.select(
        "score_country", "rows", "recipes", "mean_score", "mean_seasonality", "mean_availability", "mean_coverage"
    )


def stats_by_month(scores: DataFrame) -> DataFrame:
    return scores.groupBy("score_month").agg(F.count("*").alias("rows"), *_means())


def score_distribution(scores: DataFrame) -> DataFrame:
    """Rows per band of 20 and their share; the window sees at most five rows."""
    score = F.col("sustainability_score")
    band = (
        F.when(score < 20, "0-20")
        .when(score < 40, "20-40")
        .when(score < 60, "40-60")
        .when(score < 80, "60-80")
        .otherwise("80-100")
    )
    counted = scores.groupBy(band.alias("score_range")).agg(F.count("*").alias("rows"))
    total = F.sum("rows").over(W.partitionBy(F.lit(1)))
    return counted.withColumn(
        "percentage",
        numeric.round_half_up(F.col("rows") * F.lit(100.0) / total, 2),
    )


def column_checks(
    df: DataFrame,
    not_null: list[str] = (),
    unique: list[str] = (),
    ranges: dict[str, tuple[float | None, float | None]] | None = None,
) -> DataFrame:
    """Rows (check, column, violations). Null and range checks share one pass."""
    counts: list[tuple[str, str, Column]] = []
    for name in not_null:
        counts.append(("not_null", name, F.count_if(F.col(name).isNull())))
    for name, (low, high) in (ranges or {}).items():
        bad = F.lit(False)
        if low is not None:
            bad = bad | (F.col(name) < low)
        if high is not None:
            bad = bad | (F.col(name) > high)
        counts.append(("accepted_range", name, F.count_if(bad)))
    parts = []
    if counts:
        one = df.agg(*[c.alias(f"c{i}") for i, (_, _, c) in enumerate(counts)])
        items = F.array(*[
            F.struct(
                F.lit(check).alias("check"), F.lit(name).alias("column"),
                F.col(f"c{i}").alias("violations"),
            )
            for i, (check, name, _) in enumerate(counts)
        ])
        parts.append(one.select(F.explode(items).alias("r")).select("r.*"))
    for name in unique:
        repeated = (
            df.where(F.col(name).isNotNull()).groupBy(name).count().where(F.col("count") > 1)
        )
        parts.append(
            repeated.agg(F.count("*").alias("violations")).select(
                F.lit("unique").alias("check"), F.lit(name).alias("column"), "violations"
            )
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def score_contract(scores: DataFrame) -> DataFrame:
    """Bounds, null and partition figures of the score table in one row."""
    require_columns(scores, ["recipeid", "score_country", "score_month", *SCORES])
    outside = [
        F.count_if((F.col(c) < 0) | (F.col(c) > 100)).alias(f"{c}_outside") for c in SCORES
    ]
    return scores.agg(
        *outside,
        F.size(F.collect_set("score_country")).cast("long").alias("countries"),
        F.size(F.collect_set("score_month")).cast("long").alias("months"),
    )


def score_within(
    df: DataFrame, key: str, value: int, score: str, expected: float, tolerance: float
) -> DataFrame:
    """The named row if its score lies within the tolerance; empty otherwise."""
    return df.where(
        (F.col(key) == value)
        & (F.abs(F.col(score) - F.lit(expected)) <= F.lit(tolerance) + F.lit(1e-9))
    ).select(key, score)


def profile(df: DataFrame) -> DataFrame:
    """Rows, position and nulls of each column from one pass."""
    one = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)],
    )
    items = F.array(*[
        F.struct(
            F.lit(i).alias("position"), F.lit(c).alias("column"),
            F.col("_rows").alias("rows"), F.col(f"n{i}").alias("nulls"),
        )
        for i, c in enumerate(df.columns)
    ])
    return one.select(F.explode(items).alias("r")).select("r.*")


def preview(df: DataFrame, key: str, rows: int = 5) -> DataFrame:
    """First rows by key."""
    return df.orderBy(key).limit(rows)


def reconcile(left: DataFrame, right: DataFrame, key: str, score: str) -> DataFrame:
    """Agreement of two implementations: equal scores, largest gap, keys on one side only."""
    both = left.select(key, F.col(score).alias("a"), F.lit(1).alias("in_a")).join(
        right.select(key, F.col(score).alias("b"), F.lit(1).alias("in_b")), key, "full"
    )
    common = F.col("in_a").isNotNull() & F.col("in_b").isNotNull()
    equal = F.count_if(common & F.col("a").eqNullSafe(F.col("b")))
    shared = F.count_if(common)
    return both.agg(
        shared.alias("common"),
        equal.alias("identical"),
        numeric.round_half_up(
            F.coalesce(
                F.try_divide(equal * F.lit(100.0), shared.cast("double")), F.lit(0.0)
            ),
            1,
        ).alias("identical_percent"),
        numeric.round_half_up(
            F.coalesce(F.max(F.abs(F.col("a") - F.col("b"))), F.lit(0.0)), 2
        ).alias("largest_gap"),
        F.count_if(F.col("in_b").isNull()).alias("only_left"),
        F.count_if(F.col("in_a").isNull()).alias("only_right"),
    )


def tier_parity(country_flags: DataFrame, confidence: DataFrame) -> DataFrame:
    """Countries per data source counted from the flags and from the displayed tiers."""
    by_flag = country_flags.select(
        F.when(F.col("eufic"), "eufic").when(F.col("faostat"), "faostat").otherwise("none")
        .alias("level")
    )
    a = by_flag.groupBy("level").agg(F.count("*").alias("by_flags"))
    b = confidence.groupBy("level").agg(F.count("*").alias("by_display"))
    return a.join(b, "level", "full").select(
        "level",
        F.coalesce("by_flags", F.lit(0)).alias("by_flags"),
        F.coalesce("by_display", F.lit(0)).alias("by_display"),
    )
