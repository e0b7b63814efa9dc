"""Ingredient tokens resolved to a reference vocabulary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from larder import constants as K
from larder.functions import numeric, text
from larder.sources.staging import stage

SCORE_PLACES = 10
SLICE_TERMS = 1000
#: N-grams of a token, those of the fewest terms, whose best term sets the score to beat.
SEED_NGRAMS = 3
#: More than rounding and float sums can change in a score.
_SLACK = 1e-9


def build_vocabulary(season: DataFrame, production: DataFrame) -> DataFrame:
    """Rows (term, source, priority): the seasonal source wins for a name in both.

    The order of the vocabulary is (priority, term); ties are broken by these two columns, so
    no global row number is needed.
    """

    def names(df: DataFrame, priority: int) -> DataFrame:
        return df.where(F.col("product_name").isNotNull()).select(
            F.col("product_name").alias("term"), F.lit(priority).alias("priority")
        )

    return (
        names(season, 0)
        .unionByName(names(production, 1))
        .groupBy("term")
        .agg(F.min("priority").alias("priority"))
        .select(
            "term",
            F.when(F.col("priority") == 0, K.SEASON_SOURCE)
            .otherwise(K.PRODUCTION_SOURCE)
            .alias("source"),
            "priority",
        )
    )


def recipe_tokens(recipes: DataFrame, keep_all: bool = False) -> DataFrame:
    """Rows (recipeid, pos, ingredient_token), each token once per recipe.

    Recipes are unique, so duplicates are removed inside the row and nothing is shuffled.
    """
    tokens = text.usable_tokens(F.col("recipeingredientparts"))
    exploded = F.posexplode_outer(tokens) if keep_all else F.posexplode(tokens)
    return recipes.select("recipeid", exploded.alias("pos", "ingredient_token"))


def distinct_tokens(recipes: DataFrame) -> DataFrame:
    return recipe_tokens(recipes).select("ingredient_token").distinct()


def ngram_index(vocabulary: DataFrame) -> DataFrame:
    """Rows (term, source, priority, ngram, idf, weight) with unit-length term vectors."""
    keys = ["term", "source", "priority"]
    counts = (
        vocabulary.select(*keys, F.explode(text.padded_ngrams(F.col("term"))).alias("ngram"))
        .groupBy(*keys, "ngram")
        .agg(F.count("*").alias("tf"))
    )
    terms = vocabulary.agg(F.count("*").cast("double")).scalar()
    idf = counts.groupBy("ngram").agg(F.count("*").cast("double").alias("df")).select(
        "ngram", (F.log((F.lit(1.0) + terms) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)).alias("idf")
    )
    raw = counts.join(idf, "ngram").withColumn(
        "raw", (F.lit(1.0) + F.log(F.col("tf").cast("double"))) * F.col("idf")
    )
    # A term has only as many n-grams as characters, so this window never grows.
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(W.partitionBy("term")))
    return raw.withColumn("weight", F.col("raw") / norm).select(*keys, "ngram", "idf", "weight")


def ngram_bounds(index: DataFrame) -> DataFrame:
    """Rows (ngram, idf, postings, top, slices): top is the largest weight that any term has there."""
    return index.groupBy("ngram").agg(
        F.first("idf").alias("idf"),
        F.count("*").alias("postings"),
        F.max("weight").alias("top"),
        F.ceil(F.count("*") / F.lit(SLICE_TERMS)).cast("int").alias("slices"),
    )


def token_vectors(tokens: DataFrame, bounds: DataFrame) -> DataFrame:
    """Rows (ingredient_token, ngram, unit, slices, pos, rest, after): known n-grams, fewest terms first.

    ``rest`` is what this n-gram and those behind it can add to any term, ``after`` what those behind
    it can: the sum of units times largest weights, or the norm of the units, as terms have norm 1.
    """
    token = W.partitionBy("ingredient_token")
    rarest = token.orderBy("postings", "ngram")

    def at_most(window: W) -> Column:
        most = F.sum(F.col("unit") * F.col("top")).over(window)
        norm = F.sqrt(F.sum(F.col("unit") * F.col("unit")).over(window))
        return F.coalesce(F.least(most, norm), F.lit(0.0))

    return (
        tokens.select(
            "ingredient_token",
            F.explode(text.padded_ngrams(F.col("ingredient_token"))).alias("ngram"),
        )
        .groupBy("ingredient_token", "ngram")
        .agg(F.count("*").cast("double").alias("tf"))
        .join(bounds, "ngram")
        .withColumn("raw", (F.lit(1.0) + F.log("tf")) * F.col("idf"))
        .withColumn("unit", F.col("raw") / F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(token)))
        .select(
            "ingredient_token", "ngram", "unit", "slices",
            F.row_number().over(rarest).alias("pos"),
            at_most(rarest.rowsBetween(W.currentRow, W.unboundedFollowing)).alias("rest"),
            at_most(rarest.rowsBetween(1, W.unboundedFollowing)).alias("after"),
        )
    )


def candidate_terms(vectors: DataFrame, index: DataFrame, bounds: DataFrame) -> DataFrame:
    """Rows (ingredient_token, term): every term that can be a token's best, few others.

    The terms of a token's rarest n-grams are met first; the one that gains most by them is scored in
    full, which no best term falls short of. N-grams whose rest cannot reach that score are not
    looked up, and a found term that cannot reach it with all that is left is dropped.
    """
    # N-grams of many terms are cut into slices of the index, each met by all its tokens.
    sliced = index.join(bounds.select("ngram", "slices"), "ngram").select(
        "term", "ngram", "weight", F.pmod(F.xxhash64("term"), F.col("slices")).cast("int").alias("slice")
    )

    def met(grams: DataFrame, *kept: Column) -> DataFrame:
        return (
            grams.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
            .join(sliced, ["ngram", "slice"])
            .groupBy("ingredient_token", "term")
            .agg(F.sum(F.col("unit") * F.col("weight")).alias("part"), *kept)
        )

    seeds = (
        met(vectors.where(F.col("pos") <= SEED_NGRAMS))
        .groupBy("ingredient_token")
        .agg(F.max(F.struct("part", "term"))["term"].alias("term"))
    )
    floors = stage(
        full_scores(seeds, vectors, index).select("ingredient_token", (F.col("dot") - _SLACK).alias("floor")),
        "match-floors",
    )
    left = F.min("after").over(W.partitionBy("ingredient_token"))
    needed = (
        vectors.join(floors, "ingredient_token").where(F.col("rest") >= F.col("floor")).withColumn("left", left)
    )
    return (
        met(needed, F.first("floor").alias("floor"), F.first("left").alias("left"))
        .where(F.col("part") + F.col("left") >= F.col("floor"))
        .select("ingredient_token", "term")
    )


def full_scores(pairs: DataFrame, vectors: DataFrame, index: DataFrame) -> DataFrame:
    """Rows (ingredient_token, term, source, priority, dot) of pairs that share an n-gram."""
    return (
        pairs.join(vectors.select("ingredient_token", "ngram", "unit"), "ingredient_token")
        .join(index.select("term", "source", "priority", "ngram", "weight"), ["term", "ngram"])
        .groupBy("ingredient_token", "term", "source", "priority")
        .agg(F.sum(F.col("unit") * F.col("weight")).alias("dot"))
    )


def match_tokens(tokens: DataFrame, vocabulary: DataFrame, index: DataFrame) -> DataFrame:
    """Best term per distinct token by cosine similarity, of the terms that bounds do not rule out.

    A token without a known n-gram gets the first term of the vocabulary, with similarity 0.
    """
    bounds = stage(ngram_bounds(index), "ngram-bounds")
    vectors = stage(token_vectors(tokens, bounds), "token-vectors")
    scored = full_scores(candidate_terms(vectors, index, bounds), vectors, index)
    rank_score = numeric.round_half_up(F.col("dot"), SCORE_PLACES)
    best = scored.groupBy("ingredient_token").agg(
        F.min(F.struct((-rank_score).alias("minus_score"), "priority", "term", "source")).alias("best")
    )
    first_term = vocabulary.agg(
        F.min(F.struct("priority", "term", "source"))
    ).scalar()
    return tokens.join(best, "ingredient_token", "left").withColumn("first_term", first_term).select(
        "ingredient_token",
        F.coalesce("best.term", "first_term.term").alias("best_term"),
        F.coalesce("best.source", "first_term.source").alias("best_source"),
        F.coalesce(numeric.round_half_up(-F.col("best.minus_score"), 4), F.lit(0.0)).alias(
            "similarity_score"
        ),
    )


def decide_matches(best: DataFrame, taxonomy: list[tuple[str, str]] | None = None) -> DataFrame:
    """Keep a match above the threshold that passes the word-family guard."""
    close = F.col("similarity_score") >= K.SIMILARITY_THRESHOLD
    family = text.same_word_family(F.col("ingredient_token"), F.col("best_term"))
    kept = close & family
    term = F.when(kept, F.col("best_term"))
    return best.select(
        "ingredient_token",
        term.alias("matched_term"),
        "similarity_score",
        F.when(kept, F.col("best_source")).otherwise(K.UNMATCHED).alias("source"),
        (close & ~family).alias("revoked"),
        F.when(kept, text.category_of(F.col("best_term"), taxonomy or []))
        .otherwise(K.OTHER_CATEGORY)
        .alias("ingredient_category"),
    )


def match_report(matches: DataFrame) -> DataFrame:
    def share(condition):
        return F.count_if(condition)

    matched = share(F.col("source") != K.UNMATCHED)
    return matches.agg(
        F.count("*").alias("tokens"),
        share(F.col("source") == K.SEASON_SOURCE).alias("eufic"),
        share(F.col("source") == K.PRODUCTION_SOURCE).alias("faostat"),
        share(F.col("source") == K.UNMATCHED).alias("unmatched"),
        share(F.col("revoked")).alias("revoked"),
        numeric.round_half_up(
            F.coalesce(
                F.try_divide(matched * F.lit(100.0), F.count("*").cast("double")), F.lit(0.0)
            ),
            1,
        ).alias("match_rate"),
    )


def match_ingredients(
    recipes: DataFrame,
    season: DataFrame,
    production: DataFrame,
    taxonomy: list[tuple[str, str]] | None = None,
) -> DataFrame:
    """Token-level match table, ready to be written."""
    vocabulary = stage(build_vocabulary(season, production), "vocabulary")
    index = stage(ngram_index(vocabulary), "ngram-index")
    best = match_tokens(stage(distinct_tokens(recipes), "distinct-tokens"), vocabulary, index)
    return decide_matches(best, taxonomy)


def is_seasonal(source, category):
    return (source == K.SEASON_SOURCE) & category.isin(*K.SEASONAL_CATEGORIES)


def recipe_ingredient_matches(recipes: DataFrame, matches: DataFrame) -> DataFrame:
    """One row per recipe and token with its match; unknown tokens are unmatched."""
    return (
        recipe_tokens(recipes)
        .join(
            matches.select(
                "ingredient_token", "matched_term", "source", "similarity_score",
                "ingredient_category",
            ),
            "ingredient_token",
            "left",
        )
        .select(
            "recipeid",
            "ingredient_token",
            "matched_term",
            F.coalesce("source", F.lit(K.UNMATCHED)).alias("source"),
            "similarity_score",
            F.coalesce("ingredient_category", F.lit(K.OTHER_CATEGORY)).alias(
                "ingredient_category"
            ),
        )
    )


def recipe_map(recipes: DataFrame, matches: DataFrame) -> DataFrame:
    """Counts per source and ordered term arrays for every recipe, in one aggregation."""
    long = (
        recipe_tokens(recipes, keep_all=True)
        .join(
            matches.select("ingredient_token", "matched_term", "source", "ingredient_category"),
            "ingredient_token",
            "left",
        )
        .withColumn(
            "source",
            F.when(
                F.col("ingredient_token").isNotNull(),
                F.coalesce("source", F.lit(K.UNMATCHED)),
            ),
        )
    )
    matched = (F.col("source") != K.UNMATCHED) & F.col("matched_term").isNotNull()
    item = F.struct("pos", "matched_term", "ingredient_category", "source")
    grouped = long.groupBy("recipeid").agg(
        F.count_if(F.col("source") == K.SEASON_SOURCE).alias("eufic_match_count"),
        F.count_if(F.col("source") == K.PRODUCTION_SOURCE).alias("faostat_match_count"),
        F.count_if(F.col("source") == K.UNMATCHED).alias("unmatched_count"),
        F.array_sort(F.collect_list(F.when(matched, item))).alias("items"),
    )

    def names(items):
        return F.transform(items, lambda i: i["matched_term"])

    def seasonal(i):
        return is_seasonal(i["source"], i["ingredient_category"])

    return grouped.select(
        "recipeid",
        "eufic_match_count",
        "faostat_match_count",
        "unmatched_count",
        names(F.col("items")).alias("matched_ingredients"),
        F.transform("items", lambda i: i["ingredient_category"]).alias("ingredient_categories"),
        names(F.filter("items", seasonal)).alias("seasonal_ingredients"),
        names(F.filter("items", lambda i: ~seasonal(i))).alias("complementary_ingredients"),
    )


def source_counts(recipe_map_table: DataFrame) -> DataFrame:
    return recipe_map_table.select(
        "recipeid", "eufic_match_count", "faostat_match_count", "unmatched_count"
    )


def match_coverage(recipe_map_table: DataFrame) -> DataFrame:
    hits = F.col("eufic_match_count") + F.col("faostat_match_count") > 0
    return recipe_map_table.agg(
        F.count_if(hits).alias("recipes_matched"), F.count("*").alias("recipes")
    )
