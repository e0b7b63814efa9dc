import re
import pytest
from pyspark.sql import functions as F

from conftest import plan
from larder.operators import serving
from larder.sources.staging import literal_table, stage

TAXONOMY = [("apple", "fruit"), ("carrot", "vegetable"), ("chicken", "meat"), ("tomato", "vegetable")]
RECS = [
    (1, "soup", "Main Dish", 20, 9, 90.0), (2, "pie", "Dessert", 60, 0, 70.0),
    (3, "stew", "main", None, 4, 70.0), (4, "cake", None, 10, 2, 50.0),
]
MAP = [
    (1, 1, 1, ["tomato", "garlic"]), (2, 1, 0, ["apple"]), (3, 0, 2, ["eggplants (aubergines)"]), (4, 0, 0, []),
]
SCORES = [(1, "france", 6, 40.0), (2, "france", 6, 80.0), (3, "france", 7, 99.0), (1, "spain", 6, 10.0)]
CLUSTERS = [(1, 0, "Top Rated"), (2, 1, "Quick & Easy")]


@pytest.fixture(scope="module")
def gold(spark):
    recs = spark.createDataFrame(
        RECS, "recipeid long, name string, recipecategory string, totaltime long, reviewcount long, appeal_score double"
    )
    scores = spark.createDataFrame(SCORES, "recipeid long, score_country string, score_month int, sustainability_score double")
    for name in ("seasonality_score", "availability_score", "sustainability_mean", "positive_ratio", "coverage_score"):
        scores = scores.withColumn(name, F.lit(1.0))
    clusters = spark.createDataFrame(CLUSTERS, "recipeid long, cluster_id int, cluster_label string")
    maps = spark.createDataFrame(
        MAP, "recipeid long, eufic_match_count long, faostat_match_count long, matched_ingredients array<string>"
    )
    return serving.GoldTables(
        stage(recs, "t-recs"), stage(scores, "t-scores", "score_country"), stage(clusters, "t-clusters"),
        stage(maps, "t-maps"),
    )


def ids(df):
    return [r.recipeid for r in df.collect()]


AT = ("France ", 6)


def test_view_fills_missing_scores(gold):
    rows = {r.recipeid: r for r in serving.serving_view(gold, *AT).collect()}
    assert len(rows) == 4 and rows[3].sustainability_score == 0.0 and rows[2].sustainability_score == 80.0
    assert rows[4].cluster_label is None and rows[1].score_country == "france"


def test_view_prunes_partitions(gold):
    text = plan(serving.serving_view(gold, *AT))
    assert re.search(r"PartitionFilters: \[[^\]]*score_country", text) and "EqualTo(score_month,6)" in text


def test_short_list_ranks_before_it_joins(gold):
    best = serving.recommendations(gold, *AT, limit=2)
    assert ids(best) == [1, 2]
    text = plan(best)
    assert "TakeOrderedAndProject" in text and "LeftSemi" in text


def test_lists(gold):
    assert ids(serving.by_sustainability(gold, *AT, limit=2)) == [2, 1]
    assert ids(serving.by_score(gold, *AT, score="sustainability", limit=1)) == [2]
    assert ids(serving.quick(gold, *AT, max_time=20)) == [1, 4]
    assert ids(serving.by_category(gold, *AT, category="MAIN")) == [1, 3]
    assert ids(serving.by_category(gold, *AT, category="^main$", regex=True)) == [3]
    assert ids(serving.by_id(serving.serving_view(gold, *AT), 99)) == []
    for call in (
        lambda: serving.by_score(gold, *AT, score="price"),
        lambda: serving.recommendations(gold, *AT, limit=0),
        lambda: serving.quick(gold, *AT, max_time=0),
    ):
        with pytest.raises(ValueError):
            call()


@pytest.mark.parametrize(
    "basket, expected",
    [("aubergine", [3]), (" tomato , apple,", [1, 2]), ("Tomato", [1, 2, 3, 4]), ("", [1, 2, 3, 4]),
     ("saffron", [1, 2, 3, 4])],
)
def test_basket(gold, basket, expected):
    assert ids(serving.basket_recommendations(gold, *AT, basket=basket)) == expected


def test_statistics(gold):
    row = serving.statistics(
        serving.serving_view(gold, *AT).withColumn("aggregatedrating", F.lit(4.5))
    ).first()
    assert (row.nb_recipes, row.average_appeal_score, row.max_sustainability_score) == (4, 70.0, 80.0)
    assert (row.average_total_time, row.average_rating) == (30.0, 4.5)


def test_relevance_prefers_more_hits(gold):
    rows = {r.recipeid: r for r in serving.with_relevance(
        serving.serving_view(gold, *AT), ["tomato", "garlic"]).collect()}
    assert rows[1].basket_match_score == 100.0 and rows[1].recommendation_score == 80.0
    assert rows[2].basket_match_count == 0 and rows[2].recommendation_score == 38.0


@pytest.mark.parametrize(
    "basket, fallback, tier, expected",
    [(["tomato"], ["apple"], "basket", [1]), (["saffron"], ["apple"], "seasonal", [2]),
     (["saffron"], ["kiwi"], "global", [2, 1, 3, 4]), (["saffron"], None, "global", [2, 1, 3, 4]),
     ([], ["apple"], "seasonal", [2])],
)
def test_tiers(gold, basket, fallback, tier, expected):
    rows = serving.filter_by_basket(serving.serving_view(gold, *AT), basket, fallback)
    rows = rows.orderBy(*serving.tier_order())
    assert ids(rows) == expected and {r.tier for r in rows.collect()} == {tier}


def test_segment_filter(gold):
    view = serving.serving_view(gold, *AT)
    assert ids(serving.filter_segments(view, ["Top Rated"])) == [1]
    ignored = serving.filter_segments(view, ["Nothing"]).collect()
    assert len(ignored) == 4 and all(r.filter_ignored for r in ignored)
    assert serving.filter_segments(view, []).count() == 4


def test_time_sort_and_overview(gold):
    view = serving.with_relevance(serving.serving_view(gold, *AT), ["tomato"])
    assert sorted(ids(serving.within_time(view, 60))) == [1, 2, 4]
    assert ids(serving.sort_by_mode(view, "appeal")) == [1, 2, 3, 4]
    assert ids(serving.sort_by_mode(view, "compromise")) == [1, 2, 3, 4]
    assert ids(serving.sort_by_mode(view, "sustainability", 2)) == [1, 2]
    assert tuple(serving.overview(serving.sort_by_mode(view, "appeal", 2)).first()) == (2, 80.0, 60.0, 40.0)


def test_flags_bands_badges_and_text(gold):
    view = serving.serving_view(gold, *AT)
    flag = serving.season_flag(F.col("matched_ingredients"), F.col("faostat_match_count"), ["apple"], False)
    assert {r[0]: r[1] for r in view.select("recipeid", flag).collect()} == {1: "🟡", 2: "🟢", 3: "🟡", 4: ""}
    assert [(r.recipeid, r.badge) for r in serving.rank_badges(view, "appeal_score", 4).orderBy("place").collect()] == [
        (1, "🥇 "), (2, "🥈 "), (3, "🥉 "), (4, ""),
    ]
    df = view.select("recipeid", serving.explanation(["tomato", "garlic"]).alias("t")).orderBy("recipeid")
    assert [r.t for r in df.collect()] == [
        "Recommended because: popular (9 reviews), ready in 20 min, matches: garlic, tomato.",
        "Recommended because: ready in 60 min.",
        "Recommended because: popular (4 reviews).",
        "Recommended because: popular (2 reviews), ready in 10 min.",
    ]
    bands = view.select("recipeid", serving.score_band(F.col("sustainability_score")))
    assert dict(map(tuple, bands.collect())) == {1: "🟡 Moyen", 2: "🌱 Très durable", 3: "🔴 Faible", 4: "🔴 Faible"}


BUCKETS = "matched_ingredients array<string>, ingredient_categories array<string>"


def test_buckets_from_categories(spark):
    df = spark.createDataFrame(
        [(["apple", "chicken", "carrot"], ["fruit", "meat", "other"]), (["apple"], ["meat"]), (["nut"], ["a", "b"]), (None, None)],
        BUCKETS,
    )
    got = {r.name: r.bucket for r in serving.ingredient_buckets(df, TAXONOMY).collect()}
    assert got == {"apple": "seasonal", "carrot": "seasonal", "chicken": "complementary", "nut": "complementary"}
    v2 = {(r.name, r.category, r.is_seasonal) for r in serving.ingredient_buckets_v2(df, TAXONOMY).collect()}
    assert v2 == {("apple", "fruit", True), ("carrot", "vegetable", True), ("chicken", "meat", False), ("nut", "other", False)}


def test_ready_buckets(spark):
    df = spark.createDataFrame(
        [(["apple", " apple "], ["chicken", "apple", ""])],
        "seasonal_ingredients array<string>, complementary_ingredients array<string>",
    )
    got = {(r.name, r.bucket, r.seasonality_available, r.seasonality_source)
           for r in serving.ingredient_buckets(df, TAXONOMY).collect()}
    assert got == {("apple", "seasonal", True, "EUFIC"), ("chicken", "complementary", True, "EUFIC")}
    v2 = {(r.name, r.bucket, r.occurrences) for r in serving.ingredient_buckets_v2(df, TAXONOMY).collect()}
    assert v2 == {("apple", "seasonal", 2), ("apple", "complementary", 1), ("chicken", "complementary", 1)}


def test_plain_buckets_have_no_season(spark):
    df = spark.createDataFrame([(["apple"],)], "matched_ingredients array<string>")
    row = serving.ingredient_buckets(df, TAXONOMY).first()
    assert (row.bucket, row.seasonality_available, row.seasonality_source) == ("complementary", False, None)


def test_countries_and_confidence(spark):
    season = spark.createDataFrame([("france",), ("czechrepublic",)], "country string")
    production = spark.createDataFrame([("france",), ("peru",), (None,)], "country_name string")
    flags = serving.countries(season, production)
    assert [tuple(r) for r in flags.collect()] == [
        ("czechrepublic", True, False), ("france", True, True), ("peru", False, True),
    ]
    assert {tuple(r) for r in serving.confidence(flags).collect()} == {
        ("France", "eufic"), ("Czech Republic", "eufic"), ("Peru", "faostat"),
    }


def test_staples_leave_out_aggregates(spark):
    rows = [("france", "wheat", 2022, 5.0), ("france", "meat, total", 2022, 99.0), ("france", "Meat Equivalent", 2022, 9.0),
            ("france", "corn", 2021, 50.0), ("france", "rye", 2022, 7.0), ("peru", "maca", 2020, 1.0)]
    df = spark.createDataFrame(rows, "country_name string, product_name string, year long, production_value double")
    assert [r.product_name for r in serving.staples(df, "France").collect()] == ["rye", "wheat"]
    got = {(r.country_name, r.rank, r.product_name) for r in serving.staples_by_country(df, 1).collect()}
    assert got == {("france", 1, "rye"), ("peru", 1, "maca")}
    with pytest.raises(LookupError):
        serving.staples(df, "narnia")
    assert serving.staples(df, "narnia", strict=False).count() == 0


def test_seasonal_products_option(spark):
    df = spark.createDataFrame(
        [("fig", "unitedkingdom", 6, True), ("kiwi", "unitedkingdom", 6, False)],
        "product_name string, country string, month_number long, is_in_season boolean",
    )
    assert serving.seasonal_products(df, "United Kingdom", 6).count() == 2
    assert serving.seasonal_products(df, "United Kingdom", 6, True).count() == 1
    for country, month in (("narnia", 6), ("United Kingdom", 7)):
        with pytest.raises(LookupError):
            serving.seasonal_products(df, country, month)
        assert serving.seasonal_products(df, country, month, strict=False).count() == 0


def options(spark, names):
    return spark.createDataFrame([(i, n) for i, n in enumerate(names)], "pos long, name string")


def test_unique_options(spark):
    got = serving.unique_options(options(spark, ["Tomatoes", "tomato", "figs", None, "fig"])).orderBy("pos")
    assert [r.name for r in got.collect()] == ["Tomatoes", "figs", "fig"]


def test_option_lists_are_exclusive(spark):
    got = serving.option_lists(
        options(spark, ["apples", "carrot", "chicken"]),
        options(spark, ["apple", "chicken", "tomato"]),
        options(spark, ["Carrots", "tomatoes", "chickens", "rice"]),
        TAXONOMY,
    ).orderBy("turn", "pos").collect()
    assert [r.name for r in got if r.list == "seasonal"] == ["apples", "carrot"]
    assert [r.name for r in got if r.list == "complementary"] == ["chicken", "tomatoes", "rice"]
    assert serving.merged_basket(["a", "b"], ["b", "c"]) == ["a", "b", "c"]


def test_localised_labels(spark):
    dictionary = literal_table(spark, "term string, label string", [("carrot", "carotte"), ("egg", "oeuf"), ("eggs", "oeuf")])
    got = serving.localised_labels(options(spark, ["Carrots", "egg", "eggs", "nut"]), dictionary).orderBy("pos")
    assert [r.label for r in got.collect()] == ["carotte", "oeuf", "oeuf (eggs)", "nut"]


def test_response_and_counts(gold):
    view = serving.serving_view(gold, *AT)
    got = serving.response(view.withColumn("matched_ingredients", F.lit(None).cast("array<string>")))
    assert "score_month" not in got.columns and got.first().matched_ingredients == []
    assert serving.qualifying_count(view, ["tomato", "apple"]).first()[0] == 2
    assert sorted(r[0] for r in serving.segment_labels(gold.clusters).collect()) == ["Quick & Easy", "Top Rated"]


def test_unknown_contexts_raise_and_compound_names_are_found(gold, spark):
    for country, month in (("Nowhere", 6), (AT[0], 13)):
        with pytest.raises(LookupError):
            serving.serving_view(gold, country, month)
        with pytest.raises(LookupError):
            serving.recommendations(gold, country, month)
    loose = serving.serving_view(gold, "Nowhere", 6, strict=False)
    assert {r.sustainability_score for r in loose.collect()} == {0.0}
    compound = gold.sustainability.withColumn("score_country", F.lit("unitedkingdom"))
    assert serving.context_scores(compound, " United Kingdom", 6).count() > 0
    assert serving.context_scores(compound, "united kingdom", 6).count() == serving.context_scores(compound, "UnitedKingdom", 6).count()


def test_flags_from_narrow_tables_leave_one_pass(gold):
    view = serving.serving_view(gold, *AT)
    narrow = serving.narrow_flags(gold, gold.recipe_map, "matched_ingredients")
    same = serving.filter_by_basket(view, ["tomato"], ["garlic"]).select("recipeid", "tier", "basket_match_count")
    once = serving.filter_by_basket(view, ["tomato"], ["garlic"], narrow).select("recipeid", "tier", "basket_match_count")
    assert sorted(map(tuple, same.collect())) == sorted(map(tuple, once.collect()))
    assert plan(once).count("score_country") < plan(same).count("score_country")


def test_buckets_of_a_map_without_ingredients(gold):
    bare = gold.recipe_map.select("recipeid")
    assert serving.ingredient_buckets(bare, []).count() == 0
    assert serving.ingredient_buckets_v2(bare, []).count() == 0
