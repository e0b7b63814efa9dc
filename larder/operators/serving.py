"""Ranked, filtered and basket queries over the joined Gold tables.

Each function returns a DataFrame. Fallbacks are decided inside the plan by scalar subqueries.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from larder import constants as K
from larder.functions import numeric, text
from larder.operators.scoring import ranked, top

SCORE_COLUMNS = (
    "seasonality_score", "availability_score", "sustainability_mean", "positive_ratio",
    "sustainability_score", "coverage_score",
)
SORT_MODES = {
    "appeal": ("basket_match_count", "appeal_score"),
    "sustainability": ("basket_match_count", "sustainability_score", "appeal_score"),
    "compromise": (
        "recommendation_score", "basket_match_count", "sustainability_score", "appeal_score",
    ),
}


@dataclass(frozen=True)
class GoldTables:
    """The Gold tables behind the serving queries."""

    recommendations: DataFrame
    sustainability: DataFrame
    clusters: DataFrame
    recipe_map: DataFrame
    sentiment: DataFrame | None = None


def context_scores(sustainability: DataFrame, country: str, month: int) -> DataFrame:
    """Scores of one context; both conditions reach the scan as partition and row-group filters.

    Countries are compared by their key, so "United Kingdom" finds unitedkingdom.
    """
    return sustainability.where(
        (text.country_key(F.col("score_country")) == text.country_key(F.lit(country)))
        & (F.col("score_month") == month)
    ).select("recipeid", *SCORE_COLUMNS)


def check_context(gold: GoldTables, country: str, month: int) -> None:
    """Raise for a country and month without scores; one row of one partition is read."""
    if context_scores(gold.sustainability, country, month).limit(1).isEmpty():
        raise LookupError(f"no scores for country {country!r}, month {month}")


def serving_view(
    gold: GoldTables, country: str, month: int, rows: DataFrame | None = None, strict: bool = True
) -> DataFrame:
    """Recommendations with the scores, segment and ingredients for one country and month.

    A context without any score raises, as the endpoints do; with ``strict=False`` all scores are 0.

    ``rows`` is a short list of recommendations (at most 100, see ``check_limit``). Its ids are
    broadcast and cut down every other table at its scan, so nothing large is shuffled.
    """
    if strict:
        check_context(gold, country, month)
    base = gold.recommendations if rows is None else rows
    sides = [
        context_scores(gold.sustainability, country, month),
        gold.clusters.select("recipeid", "cluster_id", "cluster_label"),
        gold.recipe_map,
    ]
    if gold.sentiment is not None:
        sides.append(gold.sentiment.select("recipeid", "mean_sentiment_score"))
    ids = None if rows is None else F.broadcast(rows.select("recipeid"))
    view = base
    for side in sides:
        if ids is not None:
            side = side.join(ids, "recipeid", "left_semi")
        view = view.join(side, "recipeid", "left")
    return (
        view.na.fill(0.0, subset=list(SCORE_COLUMNS))
        .withColumn("score_country", text.country_key(F.lit(country)))
        .withColumn("score_month", F.lit(month))
    )


def short_list(
    gold: GoldTables, country: str, month: int, ranked_rows: DataFrame, score: str, limit: int
) -> DataFrame:
    """Response for the best rows: rank a narrow table first, join the rest afterwards."""
    best = top(ranked_rows, score, check_limit(limit)).select(gold.recommendations.columns)
    return response(ranked(serving_view(gold, country, month, best), score))


def statistics(view: DataFrame) -> DataFrame:
    def mean(name: str, places: int = 2) -> Column:
        return numeric.round_half_up(numeric.exact_mean(F.col(name), places), 2)

    return view.agg(
        F.count("*").alias("nb_recipes"),
        mean("appeal_score").alias("average_appeal_score"),
        F.max("appeal_score").alias("max_appeal_score"),
        F.min("appeal_score").alias("min_appeal_score"),
        mean("sustainability_score").alias("average_sustainability_score"),
        F.max("sustainability_score").alias("max_sustainability_score"),
        mean("coverage_score").alias("average_coverage_score"),
        mean("totaltime").alias("average_total_time"),
        mean("aggregatedrating", 6).alias("average_rating"),
    )


def response(df: DataFrame) -> DataFrame:
    """Listed columns that exist; a null ingredient list becomes an empty one."""
    kept = df.select(*[c for c in K.RESPONSE_COLUMNS if c in df.columns])
    if "matched_ingredients" in kept.columns:
        empty = F.array().cast("array<string>")
        kept = kept.withColumn("matched_ingredients", F.coalesce("matched_ingredients", empty))
    return kept


def parse_basket(basket: str) -> list[str]:
    return [item.strip() for item in basket.split(",") if item.strip()]


def recommendations(gold: GoldTables, country: str, month: int, limit: int = 10) -> DataFrame:
    return short_list(gold, country, month, gold.recommendations, "appeal_score", limit)


def check_limit(limit: int) -> int:
    if not 1 <= limit <= 100:
        raise ValueError("limit must lie between 1 and 100")
    return limit


def any_row(df: DataFrame, condition: Column) -> Column:
    """Scalar flag: some row meets the condition."""
    return df.agg(F.coalesce(F.bool_or(condition), F.lit(False))).scalar()


def basket_recommendations(
    gold: GoldTables, country: str, month: int, basket: str, limit: int = 10
) -> DataFrame:
    """Best recipes with a basket hit; all recipes when the basket is empty or never hits."""
    items = parse_basket(basket)
    rows = gold.recommendations
    if items:
        # Only the ids with a hit are joined to the recommendations.
        hit = F.size(text.basket_hits(F.col("matched_ingredients"), items)) > 0
        found = any_row(gold.recipe_map.join(rows.select("recipeid"), "recipeid", "left_semi"), hit)
        hits = gold.recipe_map.where(hit).select("recipeid", F.lit(True).alias("_hit"))
        rows = rows.join(hits, "recipeid", "left").where(F.col("_hit").isNotNull() | ~found)
    return short_list(gold, country, month, rows, "appeal_score", limit)


def by_sustainability(
    gold: GoldTables, country: str, month: int, limit: int = 10
) -> DataFrame:
    """Best recipes by sustainability; a recipe without a score counts as 0."""
    scores = context_scores(gold.sustainability, country, month).select(
        "recipeid", "sustainability_score"
    )
    joined = gold.recommendations.select("recipeid").join(scores, "recipeid", "left")
    best = top(joined.na.fill(0.0), "sustainability_score", check_limit(limit)).select("recipeid")
    rows = gold.recommendations.join(F.broadcast(best), "recipeid", "left_semi")
    return response(ranked(serving_view(gold, country, month, rows), "sustainability_score"))


def by_score(
    gold: GoldTables, country: str, month: int, score: str = "appeal", limit: int = 10
) -> DataFrame:
    if score == "appeal":
        return recommendations(gold, country, month, limit)
    if score == "sustainability":
        return by_sustainability(gold, country, month, limit)
    raise ValueError("score must be 'appeal' or 'sustainability'")


def by_id(view: DataFrame, recipeid: int) -> DataFrame:
    """One recipe with all columns; the id is pushed down to the scan of every table."""
    empty = F.array().cast("array<string>")
    found = view.where(F.col("recipeid") == recipeid)
    return found.withColumn("matched_ingredients", F.coalesce("matched_ingredients", empty))


def quick(
    gold: GoldTables, country: str, month: int, max_time: int = 30, limit: int = 20
) -> DataFrame:
    if max_time < 1:
        raise ValueError("max_time must be positive")
    rows = gold.recommendations.where(F.col("totaltime") <= max_time)
    return short_list(gold, country, month, rows, "appeal_score", limit)


def by_category(
    gold: GoldTables, country: str, month: int, category: str, limit: int = 20, regex: bool = False
) -> DataFrame:
    if regex:
        match = F.col("recipecategory").rlike("(?i)" + category)
    else:
        match = F.lower("recipecategory").contains(category.lower())
    rows = gold.recommendations.where(match)
    return short_list(gold, country, month, rows, "appeal_score", limit)


# --- ingredient buckets ---------------------------------------------------------------


def _trimmed(column: str) -> Column:
    items = F.transform(F.col(column), lambda i: F.trim(i))
    return F.filter(items, lambda i: i != "")


def _named(df: DataFrame, column: str, seasonal: bool) -> DataFrame:
    return df.select(
        F.explode(_trimmed(column)).alias("name"), F.lit(seasonal).alias("is_seasonal")
    )


def _with_categories(df: DataFrame, taxonomy: list[tuple[str, str]], fallback: str) -> DataFrame:
    """Rows (name, category) of aligned lists; lists of other lengths are looked up again.

    Occurrences are reduced to distinct pairs before the taxonomy lookup.
    """
    names, categories = _trimmed("matched_ingredients"), _trimmed("ingredient_categories")
    aligned = F.coalesce(F.size(names) == F.size(categories), F.lit(False))
    blanks = F.transform(names, lambda _: F.lit(None).cast("string"))
    pairs = (
        df.select(
            F.explode(
                F.arrays_zip(
                    names.alias("name"),
                    F.when(aligned, categories).otherwise(blanks).alias("category"),
                )
            ).alias("p")
        )
        .select("p.name", F.lower(F.trim("p.category")).alias("category"))
        .distinct()
    )
    looked_up = text.category_of(F.col("name"), taxonomy)
    known = F.col("category").isNotNull() & (F.col("category") != K.OTHER_CATEGORY)
    return pairs.withColumn(
        "category", F.when(known, F.col("category")).otherwise(looked_up)
    )


def _metadata(df: DataFrame) -> DataFrame:
    seasonal = any_row(df, F.col("bucket") == "seasonal")
    return df.withColumn("seasonality_available", seasonal).withColumn(
        "seasonality_source", F.when(F.col("seasonality_available"), F.lit("EUFIC"))
    ).withColumn("complementary_source", F.lit(K.COMPLEMENTARY_SOURCE))


def ingredient_buckets(recipe_map: DataFrame, taxonomy: list[tuple[str, str]]) -> DataFrame:
    """Disjoint seasonal and complementary names; the path depends on the columns present.

    A map without any ingredient column gives no rows. One aggregation per name decides its bucket, so no anti join is needed.
    """
    columns = set(recipe_map.columns)
    if {"seasonal_ingredients", "complementary_ingredients"} <= columns:
        names = _named(recipe_map, "seasonal_ingredients", True).unionByName(
            _named(recipe_map, "complementary_ingredients", False)
        )
    elif {"matched_ingredients", "ingredient_categories"} <= columns:
        names = _with_categories(recipe_map, taxonomy, K.OTHER_CATEGORY).select(
            "name", F.col("category").isin(*K.SEASONAL_CATEGORIES).alias("is_seasonal")
        )
    elif "matched_ingredients" in columns:
        names = _named(recipe_map, "matched_ingredients", False)
    else:
        names = recipe_map.limit(0).select(
            F.lit(None).cast("string").alias("name"), F.lit(False).alias("is_seasonal")
        )
    grouped = names.groupBy("name").agg(F.bool_or("is_seasonal").alias("is_seasonal"))
    return _metadata(
        grouped.select(
            F.when(F.col("is_seasonal"), "seasonal").otherwise("complementary").alias("bucket"),
            "name",
        )
    )


def ingredient_buckets_v2(recipe_map: DataFrame, taxonomy: list[tuple[str, str]]) -> DataFrame:
    """Names with category and flag.

    With ready buckets a name keeps its number of occurrences; otherwise items are unique by
    lower-case name and category, and a name that is seasonal anywhere is not complementary.
    """
    columns = set(recipe_map.columns)
    category = text.category_of(F.col("name"), taxonomy)
    if {"seasonal_ingredients", "complementary_ingredients"} <= columns:
        counted = (
            _named(recipe_map, "seasonal_ingredients", True)
            .unionByName(_named(recipe_map, "complementary_ingredients", False))
            .groupBy("name", "is_seasonal")
            .agg(F.count("*").alias("occurrences"))
        )
        items = counted.select(
            F.when(F.col("is_seasonal"), "seasonal").otherwise("complementary").alias("bucket"),
            "name", category.alias("category"), "is_seasonal", "occurrences",
        )
        return _metadata(items)
    if "matched_ingredients" not in columns:
        recipe_map = recipe_map.limit(0).withColumn(
            "matched_ingredients", F.lit(None).cast("array<string>")
        )
    if "ingredient_categories" not in columns:
        recipe_map = recipe_map.withColumn(
            "ingredient_categories", F.lit(None).cast("array<string>")
        )
    pairs = _with_categories(recipe_map, taxonomy, K.OTHER_CATEGORY)
    grouped = (
        pairs.groupBy(F.lower("name").alias("key"), "category")
        .agg(F.min("name").alias("name"))
        .withColumn("is_seasonal", F.col("category").isin(*K.SEASONAL_CATEGORIES))
        # One row per category of a name, so the window is no larger than the taxonomy.
        .withColumn("any_seasonal", F.bool_or("is_seasonal").over(W.partitionBy("key")))
    )
    items = grouped.where(F.col("is_seasonal") | ~F.col("any_seasonal")).select(
        F.when(F.col("is_seasonal"), "seasonal").otherwise("complementary").alias("bucket"),
        "name", "category", "is_seasonal", F.lit(1).cast("long").alias("occurrences"),
    )
    return _metadata(items)


# --- countries, seasonal products, staples ---------------------------------------------


def seasonal_products(
    season: DataFrame, country: str, month: int, in_season_only: bool = False, strict: bool = True
) -> DataFrame:
    """Products listed for a country and month, with their flag.

    A country and month that the source does not list raises; with ``strict=False`` it has no rows.
    """
    rows = season.where(
        (F.col("country") == text.country_key(F.lit(country))) & (F.col("month_number") == month)
    )
    if strict and rows.limit(1).isEmpty():
        raise LookupError(f"no seasonal products for country {country!r}, month {month}")
    if in_season_only:
        rows = rows.where(F.col("is_in_season"))
    return rows.select("product_name", "is_in_season").distinct()


def specific_products(production: DataFrame) -> DataFrame:
    name = F.lower("product_name")
    aggregate = F.lit(False)
    for pattern in K.AGGREGATE_PATTERNS:
        aggregate = aggregate | name.contains(pattern)
    return production.where(~aggregate)


def staples(production: DataFrame, country: str, top_n: int = 15, strict: bool = True) -> DataFrame:
    """Largest products of a country in its latest year, without aggregate rows.

    A country that the source does not list raises; with ``strict=False`` it has no rows.
    """
    rows = production.where(F.col("country_name") == country.lower().strip())
    if strict and rows.limit(1).isEmpty():
        raise LookupError(f"no production figures for country {country!r}")
    latest = rows.agg(F.max("year")).scalar()
    return (
        specific_products(rows.where(F.col("year") == latest))
        .orderBy(F.desc("production_value"), "product_name")
        .limit(check_limit(top_n))
        .select("product_name", "production_value")
    )


def staples_by_country(production: DataFrame, top_n: int = 15) -> DataFrame:
    """The same for all countries; rows are cut to ``top_n`` per country before the shuffle."""
    latest = production.groupBy("country_name").agg(F.max("year").alias("year"))
    rank = F.row_number().over(
        W.partitionBy("country_name").orderBy(F.desc("production_value"), "product_name")
    )
    return (
        specific_products(production.join(latest, ["country_name", "year"]))
        .withColumn("rank", rank)
        .where(F.col("rank") <= top_n)
        .select("country_name", "rank", "product_name", "production_value")
    )


def countries(season: DataFrame, production: DataFrame) -> DataFrame:
    """All country keys in order, with one flag per source: a union and one aggregation."""

    def keys(df: DataFrame, column: str, in_season: bool) -> DataFrame:
        return df.where(F.col(column).isNotNull()).select(
            F.col(column).alias("country"),
            F.lit(in_season).alias("e"),
            F.lit(not in_season).alias("f"),
        )

    return (
        keys(season, "country", True)
        .unionByName(keys(production, "country_name", False))
        .groupBy("country")
        .agg(F.bool_or("e").alias("eufic"), F.bool_or("f").alias("faostat"))
        .orderBy("country")
    )


def confidence(country_flags: DataFrame) -> DataFrame:
    """Displayed countries with the best data source each has."""
    shown = country_flags.groupBy(text.country_display(F.col("country")).alias("country")).agg(
        F.bool_or("eufic").alias("e"), F.bool_or("faostat").alias("f")
    )
    return shown.select(
        "country",
        F.when(F.col("e"), "eufic").when(F.col("f"), "faostat").otherwise("none").alias("level"),
    )


# --- baskets ----------------------------------------------------------------------------


def with_relevance(df: DataFrame, basket: list[str]) -> DataFrame:
    """Match count, match share and combined score for a basket."""
    return _relevance(
        df.withColumn(
            "basket_match_count",
            F.size(text.basket_hits(F.col("matched_ingredients"), basket)),
        ),
        F.lit(float(max(len(set(basket)), 1))),
    )


def _relevance(df: DataFrame, size: Column) -> DataFrame:
    share = F.least(F.col("basket_match_count") / size * F.lit(100.0), F.lit(100.0))
    combined = (
        F.lit(K.WEIGHT_BASKET) * F.col("basket_match_score")
        + F.lit(K.WEIGHT_SUSTAINABILITY) * F.coalesce("sustainability_score", F.lit(0.0))
        + F.lit(K.WEIGHT_APPEAL) * F.coalesce("appeal_score", F.lit(0.0))
    )
    return df.withColumn("basket_match_score", numeric.round_half_up(share, 2)).withColumn(
        "recommendation_score", numeric.round_half_up(combined, 2)
    )


def narrow_flags(gold: GoldTables, side: DataFrame, *columns: str) -> DataFrame:
    """The rows of one narrow table that the serving view shows, for flags over the whole view."""
    return side.select("recipeid", *columns).join(
        gold.recommendations.select("recipeid"), "recipeid", "left_semi"
    )


def filter_by_basket(
    view: DataFrame, basket: list[str], fallback: list[str] | None = None,
    flags_from: DataFrame | None = None,
) -> DataFrame:
    """Rows of the first tier that is not empty, with the tier in a column.

    ``flags_from`` holds the same ingredient lists as the view in a narrow table, so that the
    view itself is computed once.

    Tiers: ``basket`` hits, ``seasonal`` (fallback) hits, ``global``. The result is ordered by
    the caller or by ``tier_order``.
    """
    hits = F.size(text.basket_hits(F.col("matched_ingredients"), basket))
    back = F.size(text.basket_hits(F.col("matched_ingredients"), fallback or []))
    flags = (view if flags_from is None else flags_from).agg(
        F.struct(
            F.coalesce(F.bool_or(hits > 0), F.lit(False)).alias("basket"),
            F.coalesce(F.bool_or(back > 0), F.lit(False)).alias("seasonal"),
        )
    ).scalar()
    tier = (
        F.when(F.col("_any.basket"), "basket")
        .when(F.col("_any.seasonal"), "seasonal")
        .otherwise("global")
    )
    in_tier = F.when(F.col("tier") == "seasonal", back).otherwise(hits)
    size = F.when(
        F.col("tier") == "seasonal", F.lit(float(max(len(set(fallback or [])), 1)))
    ).otherwise(F.lit(float(max(len(set(basket)), 1))))
    rows = (
        view.withColumn("_any", flags)
        .withColumn("tier", tier)
        .withColumn("basket_match_count", in_tier)
        .where((F.col("tier") == "global") | (F.col("basket_match_count") > 0))
    )
    return _relevance(rows, size).drop("_any")


def tier_order() -> list[Column]:
    """Order of basket results; in the global tier every match count is equal."""
    return [
        F.when(F.col("tier") == "global", F.lit(0)).otherwise(F.col("basket_match_count")).desc(),
        F.col("recommendation_score").desc(),
        F.col("sustainability_score").desc_nulls_last(),
        F.col("appeal_score").desc_nulls_last(),
        F.col("recipeid").asc(),
    ]


def filter_segments(
    df: DataFrame, labels: list[str], flags_from: DataFrame | None = None
) -> DataFrame:
    """Rows of the chosen segments; all rows, flagged, when none would remain.

    ``flags_from`` holds the same labels in a narrow table.
    """
    if not labels:
        return df.withColumn("filter_ignored", F.lit(False))
    wanted = F.coalesce(F.col("cluster_label").isin(*labels), F.lit(False))
    return df.withColumn("filter_ignored", ~any_row(df if flags_from is None else flags_from, wanted)).where(
        wanted | F.col("filter_ignored")
    )


def within_time(df: DataFrame, max_time: int) -> DataFrame:
    return df.where(F.coalesce("totaltime", F.lit(K.MISSING_MINUTES)) <= max_time)


def sort_by_mode(df: DataFrame, mode: str, rows: int = 10) -> DataFrame:
    order = [F.col(c).desc_nulls_last() for c in SORT_MODES[mode]]
    return df.orderBy(*order, F.col("recipeid")).limit(rows)


def overview(shown: DataFrame) -> DataFrame:
    """Means over the rows shown."""
    def mean(name: str, places: int) -> Column:
        return numeric.round_half_up(numeric.exact_mean(F.col(name), 2), places)

    return shown.agg(
        F.count("*").alias("recipes"),
        mean("appeal_score", 1).alias("mean_appeal_score"),
        mean("sustainability_score", 1).alias("mean_sustainability_score"),
        mean("totaltime", 0).alias("mean_totaltime"),
    )


def season_flag(ingredients: Column, production_count: Column, basket: list[str],
                country_in_season_source: bool) -> Column:
    hit = F.size(text.basket_hits(ingredients, basket)) > 0
    fallback = F.lit(not country_in_season_source) & (F.coalesce(production_count, F.lit(0)) > 0)
    return F.when(hit, K.FLAG_HIT).when(fallback, K.FLAG_PRODUCTION).otherwise("")


def score_band(score: Column) -> Column:
    value = F.coalesce(score, F.lit(0.0))
    band = F.lit(K.SCORE_BANDS[-1][1])
    for bound, name in reversed(K.SCORE_BANDS[:-1]):
        band = F.when(value >= bound, F.lit(name)).otherwise(band)
    return band


def rank_badges(df: DataFrame, score: str, rows: int = 10) -> DataFrame:
    """Top rows with band and badge; only the ``rows`` kept rows enter the ordered window."""
    shown = top(df, score, check_limit(rows))
    place = F.row_number().over(W.orderBy(F.col(score).desc_nulls_last(), F.col("recipeid")))
    return shown.withColumn("place", place).withColumn(
        "badge",
        F.coalesce(
            F.get(F.array(*[F.lit(b) for b in K.RANK_BADGES]), F.col("place") - 1), F.lit("")
        ),
    )


def explanation(
    basket: list[str], fallback_mode: bool = False, texts: dict = K.EXPLANATION
) -> Column:
    """Reviews, minutes and matched terms of a row as one sentence; empty when nothing applies."""
    hits = text.basket_hits(F.col("matched_ingredients"), basket)
    reviews, minutes = F.col("reviewcount").cast("long"), F.col("totaltime").cast("long")

    def around(name: str, value: Column) -> Column:
        before, after = texts[name]
        return F.concat(F.lit(before), value, F.lit(after))

    if fallback_mode:
        terms = F.lit(texts["fallback"])
    else:
        terms = F.when(
            F.size(hits) > 0, around("seasonal", F.array_join(F.array_sort(hits), ", "))
        )
    parts = F.concat_ws(
        ", ",
        F.when(F.coalesce(reviews, F.lit(0)) != 0, around("popular", F.format_number(reviews, 0))),
        F.when(F.coalesce(minutes, F.lit(0)) != 0, around("time", minutes.cast("string"))),
        terms,
    )
    return F.when(parts == "", F.lit("")).otherwise(
        F.concat(F.lit(texts["prefix"]), parts, F.lit("."))
    )


def segment_labels(clusters: DataFrame) -> DataFrame:
    return clusters.where(F.col("cluster_label").isNotNull()).select("cluster_label").distinct()


def qualifying_count(view: DataFrame, basket: list[str]) -> DataFrame:
    hit = F.size(text.basket_hits(F.col("matched_ingredients"), basket)) > 0
    return view.agg(F.count_if(hit).alias("qualifying"))


# --- option lists -------------------------------------------------------------------------


def unique_options(options: DataFrame, name: str = "name", pos: str = "pos") -> DataFrame:
    """First option per singularised key, by position."""
    key = text.singular_key(F.col(name))
    return (
        options.withColumn("key", key)
        .where(F.col("key") != "")
        .groupBy("key")
        .agg(F.min(F.struct(pos, name)).alias("first"))
        .select("key", f"first.{pos}", f"first.{name}")
    )


def option_lists(
    season_items: DataFrame,
    bucket_items: DataFrame,
    production_items: DataFrame,
    taxonomy: list[tuple[str, str]],
) -> DataFrame:
    """Exclusive lists: seasonal produce, and everything else that does not repeat it.

    Inputs are (pos, name) tables, ordered by pos and then name; ``bucket_items`` may have a
    ``category`` column.
    """

    def produce(df: DataFrame) -> Column:
        found = text.category_of(F.col("name"), taxonomy)
        if "category" in df.columns:
            found = F.coalesce(F.nullif(F.lower(F.trim("category")), F.lit("")), found)
        return found.isin(*K.SEASONAL_CATEGORIES)

    def candidates(df: DataFrame, list_name: str, turn: int, condition: Column) -> DataFrame:
        return df.where(condition).select(
            F.lit(list_name).alias("list"),
            F.lit(turn).alias("turn"),
            F.col("pos").cast("long").alias("pos"),
            F.trim("name").alias("name"),
        )

    everything = (
        candidates(season_items, "seasonal", 0, produce(season_items))
        .unionByName(candidates(bucket_items, "complementary", 1, ~produce(bucket_items)))
        .unionByName(candidates(production_items, "complementary", 2, F.lit(True)))
        .withColumn("key", text.singular_key(F.col("name")))
        .where(F.col("key") != "")
    )
    # The seasonal turn sorts first, so one minimum per key also removes repeats across lists.
    return (
        everything.groupBy("key")
        .agg(F.min(F.struct("turn", "pos", "name", "list")).alias("first"))
        .select("first.list", "first.turn", "first.pos", "first.name")
    )


def merged_basket(*selections: list[str]) -> list[str]:
    """Selections in order, each item once."""
    return list(dict.fromkeys(item for selection in selections for item in selection))


def localised_labels(options: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Label of each (pos, name): exact entry, else entry of the singular, else the name.

    A label that an earlier option with another name already has is shown as ``label (name)``.
    """
    entries = dictionary.select("term", "label")
    exact = entries.select(F.col("term").alias("raw_key"), F.col("label").alias("exact_label"))
    single = entries.select(F.col("term").alias("key"), F.col("label").alias("single_label"))
    labelled = (
        options.withColumn("raw_key", text.key_text(F.col("name")))
        .withColumn("key", text.singular_key(F.col("name")))
        .join(exact, "raw_key", "left")
        .join(single, "key", "left")
        .select(
            "pos", "name",
            F.coalesce("exact_label", "single_label", "name").alias("plain_label"),
        )
    )
    owner = labelled.groupBy("plain_label").agg(F.min_by("name", "pos").alias("owner"))
    return labelled.join(owner, "plain_label").select(
        "pos",
        "name",
        F.when(F.col("owner") == F.col("name"), F.col("plain_label"))
        .otherwise(F.concat("plain_label", F.lit(" ("), "name", F.lit(")")))
        .alias("label"),
    )
