import pytest
from pyspark.sql import functions as F

from conftest import plan
from larder.operators import cleaning
from larder.sources import schemas


def test_recipes(spark):
    rows = [
        (1, "Pie!", "PT10M", None, "PT1H10M", "Main", 'c("Apple", "Sugar")', 4.5, 3.0, "Mix."),
        (1, "Zest", "PT10M", None, "PT1H10M", "Main", "x", 4.5, 3.0, "Mix."),
        (2, None, None, "P1DT2H", None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, schemas.BRONZE_RECIPES)
    got = {r.recipeid: r for r in cleaning.clean_recipes(df).collect()}
    assert len(got) == 2
    assert (got[1].name, got[1].totaltime, got[1].preptime) == ("pie", 70, 0)
    assert got[1].recipeingredientparts == "apple sugar"
    assert (got[2].name, got[2].reviewcount, got[2].aggregatedrating) == ("", 0.0, 0.0)


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match=r"\['country', 'month'\]"):
        cleaning.clean_seasonality(
            spark.createDataFrame([("a", "b", "c", "d")],
                                  "product_name string, product_type string, source string, extracted_at string")
        )


def test_reviews_keep_first(spark):
    df = spark.createDataFrame(
        [(1, 1, 5.0, "Great!"), (1, 1, 4.0, "zz"), (2, 1, None, None)], schemas.BRONZE_REVIEWS
    )
    got = cleaning.clean_reviews(df, [F.col("rating").desc()]).orderBy("reviewid").collect()
    assert [(r.reviewid, r.rating, r.review) for r in got] == [(1, 5.0, "great"), (2, 0.0, "")]


def test_seasonality(spark):
    rows = [
        ("Tomato ", "Vegetable", "JUNE", "France", "EUFIC", "t"),
        ("tomato", "vegetable", "june", "france", "EUFIC", "t2"),
        ("fig", "fruit", "juin", "france", "EUFIC", "t"),
        (None, "fruit", "may", "france", "EUFIC", "t"),
    ]
    got = cleaning.clean_seasonality(spark.createDataFrame(rows, schemas.BRONZE_SEASONALITY)).collect()
    assert [(r.product_name, r.month_number, r.is_in_season, r.source) for r in got] == [
        ("tomato", 6, True, "eufic")
    ]


def test_production(spark):
    rows = [
        (68, "France", 388, "Tomatoes", "Production", "2022", "t", "850000"),
        (68, "France", 388, "Tomatoes", "Yield", "2022", "t", "1"),
        (68, "France", 388, "Tomatoes", "production", "2022", "t", "1"),
        (68, "France", 389, "Figs", "Production", "20x2", "t", "1"),
        (68, "France", 390, "Figs", "Production", "2022", "t", "n/a"),
    ]
    got = cleaning.clean_production(spark.createDataFrame(rows, schemas.BRONZE_PRODUCTION)).collect()
    assert [(r.product_name, r.year, r.production_value, r.source) for r in got] == [
        ("tomatoes", 2022, 850000.0, "faostat_qcl")
    ]


def test_first_per_key_limits_rows_before_the_shuffle(spark):
    hot = spark.range(1000).select(F.lit(1).alias("k"), "id").unionByName(
        spark.range(5).select(F.lit(2).alias("k"), "id")
    )
    df = cleaning.first_per_key(hot, ["k"], [F.col("id")])
    text = plan(df)
    before_exchange = text[text.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in before_exchange
    assert sorted(map(tuple, df.collect())) == [(1, 0), (2, 0)]
