import re

import pytest

from conftest import plan
from larder.operators import sustainability as su
from larder.sources import writers

MONTHS = {
    "tomato": range(6, 10), "strawberry": range(5, 8), "potato": range(7, 12),
    "carrot": [1, 2, 3, 9, 10, 11, 12], "garlic": range(7, 10),
}
PRODUCTION = [("tomato", 850000.0), ("strawberry", 60000.0), ("potato", 5400000.0), ("carrot", 500000.0),
              ("garlic (dry)", 18000.0)]
MATCHES = [
    (1, "tomatoes", "tomato", "eufic"), (1, "strawberries", "strawberry", "eufic"),
    (2, "potatoes", "potato", "eufic"), (2, "garlic", "garlic", "eufic"),
    (3, "xanthan", None, "unmatched"),
]


@pytest.fixture(scope="module")
def season(spark):
    rows = [(p, m, "france", True) for p, months in MONTHS.items() for m in months]
    rows += [("kiwi", 1, "spain", True), ("tomato", 6, "spain", False)]
    return spark.createDataFrame(rows, "product_name string, month_number long, country string, is_in_season boolean")


@pytest.fixture(scope="module")
def production(spark):
    rows = [("france", p, 2022, v, i) for i, (p, v) in enumerate(PRODUCTION)] + [("france", "kale", 2021, 9e9, 9)]
    return spark.createDataFrame(
        rows, "country_name string, product_name string, year long, production_value double, item_code long"
    )


@pytest.fixture(scope="module")
def matches(spark):
    return spark.createDataFrame(
        MATCHES, "recipeid long, ingredient_token string, matched_term string, source string"
    )


def test_availability(production):
    got = {r.product_name: r.availability_score for r in su.availability_reference(production).collect()}
    assert got["potato"] == 1.0 and got["garlic (dry)"] == 0.0 and "kale" not in got
    assert got["tomato"] == pytest.approx(832000 / 5382000)
    assert got["strawberry"] == pytest.approx(42000 / 5382000)


def test_constant_production_is_zero_and_first_product_wins(spark):
    rows = [("x", "a", 2022, 5.0, 1), ("x", "b", 2022, 5.0, 2)]
    schema = "country_name string, product_name string, year long, production_value double, item_code long"
    got = su.availability_reference(spark.createDataFrame(rows, schema)).collect()
    assert {r.availability_score for r in got} == {0.0}
    rows = [("x", "a", 2022, 5.0, 2), ("x", "a", 2022, 9.0, 1), ("x", "b", 2022, None, 3)]
    got = {r.product_name: r.availability_score
           for r in su.availability_reference(spark.createDataFrame(rows, schema)).collect()}
    assert got == {"a": 1.0, "b": 0.0}


def test_seasonality(season):
    got = su.seasonality_reference(season).where("country = 'france' and month_number = 6").collect()
    assert sorted(r.product_name for r in got) == ["strawberry", "tomato"]


def test_one_context(matches, season, production):
    got = {r.recipeid: r for r in su.sustainability_scores(matches, season, production, "France", 6).collect()}
    assert got[1].sustainability_score == 87.03 and got[1].seasonality_score == 100.0
    assert got[2].sustainability_score == 12.5 and got[2].positive_ratio == 50.0
    assert set(got) == {1, 2}


def test_every_country_and_month(matches, season, production):
    scores = su.sustainability_scores(matches, season, production)
    assert scores.count() == 2 * 2 * 12
    spain = scores.where("score_country = 'spain' and score_month = 6 and recipeid = 1").first()
    assert spain.sustainability_score == 0.0


def test_one_context_reads_one_country(spark, tmp_path, matches, season, production):
    season.write.parquet(str(tmp_path / "s"))
    production.write.parquet(str(tmp_path / "p"))
    stored = spark.read.parquet(str(tmp_path / "s")), spark.read.parquet(str(tmp_path / "p"))
    names = []
    real = su.stage
    try:
        su.stage = lambda df, name, *a: names.append((name, plan(df))) or real(df, name, *a)
        got = su.sustainability_scores(matches, *stored, " FRANCE", 6).collect()
    finally:
        su.stage = real
    assert {r.score_country for r in got} == {"france"} and {r.score_month for r in got} == {6}
    text = dict(names)["term-contexts"]
    assert "month_number" in text and "france" in text.lower()


def test_two_thirds_is_enough_for_the_bonus(spark, season, production):
    rows = [(1, t, t, "eufic") for t in ("tomato", "strawberry", "kiwi")]
    rows += [(2, t, t, "eufic") for t in ("tomato", "kiwi", "fig")]
    df = spark.createDataFrame(rows, "recipeid long, ingredient_token string, matched_term string, source string")
    got = {r.recipeid: r for r in su.sustainability_scores(df, season, production, "france", 6).collect()}
    assert got[1].sustainability_score == pytest.approx(got[1].sustainability_mean + 10, abs=0.011)
    assert got[2].sustainability_score == got[2].sustainability_mean


def test_coverage_counts_tokens(spark):
    rows = [(1, "a", "x", "eufic"), (1, "b", None, "unmatched"), (1, "c", "x", "eufic")]
    df = spark.createDataFrame(rows, "recipeid long, ingredient_token string, matched_term string, source string")
    row = su.coverage(df).first()
    assert (row.total_ingredient_tokens, row.matched_ingredient_tokens, row.coverage_score) == (3, 2, 66.67)
    assert su.prepare_matches(df).count() == 1


def test_scores_need_one_shuffle_of_the_matches(matches, season, production):
    text = plan(su.sustainability_scores(matches, season, production))
    assert text.count("Exchange hashpartitioning") == 1
    assert "BroadcastHashJoin" in text and "Window" not in text and "NestedLoop" not in text


def test_tasks_follow_the_rows_of_recipes_and_countries(monkeypatch, matches, season, production):
    whole = sorted(map(tuple, su.sustainability_scores(matches, season, production).collect()))
    monkeypatch.setattr(su, "ROWS_PER_TASK", 1)
    sums = su.folded_scores(matches, season, production, spread_countries=True)
    # Two recipes with a term and two countries: four tasks to sum, two for each country to write.
    assert "hashpartitioning(recipeid" in plan(sums) and ", 4), REPARTITION_BY_NUM" in plan(sums)
    assert sums.count() == 4
    assert sorted(map(tuple, su.score_contexts(sums).collect())) == whole


def test_stored_sums_unfold_to_the_scores_of_one_country(spark, tmp_path, matches, season, production):
    writers.write_by_country(
        su.folded_scores(matches, season, production, spread_countries=True), str(tmp_path / "g"), "country", ("recipeid",)
    )
    stored = su.score_contexts(spark.read.parquet(str(tmp_path / "g")))
    plain = su.sustainability_scores(matches, season, production)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, plain.collect()))
    assert re.search(r"PartitionFilters: \[[^\]]*country", plan(stored.where("score_country = 'france' and score_month = 6")))
