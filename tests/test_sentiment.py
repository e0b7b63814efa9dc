import math
import random

import pandas as pd
import pytest
from conftest import plan
from larder.operators import sentiment
from larder.operators.sentiment import SentimentRules
from larder.sources.staging import literal_table

LEXICON = [("good", 1.9), ("great", 3.1), ("bad", -2.5), ("no", -1.2), ("love", 3.2)]


@pytest.fixture(scope="module")
def lexicon(spark):
    return literal_table(spark, "word string, valence double", LEXICON)


def scores(spark, lexicon, reviews):
    rows = [(i, i % 2, r) for i, r in enumerate(reviews)]
    df = spark.createDataFrame(rows, "reviewid long, recipeid long, review string")
    return [r.sentiment_score for r in sentiment.score_reviews(df, lexicon).orderBy("reviewid").collect()]


def expected(total):
    return pytest.approx(round((round(total / math.sqrt(total * total + 15), 4) + 1) * 50, 2), abs=0.011)


def test_rules(spark, lexicon):
    cases = {
        "good": 1.9,
        "very good": 1.9 + 0.293,
        "really very good": 1.9 + 0.293 + 0.293 * 0.95,
        "very bad": -2.5 - 0.293,
        "slightly good": 1.9 - 0.293,
        "not good": 1.9 * -0.74,
        "not very good": (1.9 + 0.293) * -0.74,
        "not a b good": 1.9 * -0.74,
        "not a b c good": 1.9,
        "never so good": 1.9 * 1.25 + 0.293 * 1.25,
        "without doubt good": 1.9,
        "without a good": 1.9 * -0.74,
        "good but bad": 1.9 * 0.5 - 2.5 * 1.5,
        "least good": 1.9 * -0.74,
        "at least good": 1.9,
        "no good": 1.9 * -0.74,
        "great good": 3.1 + 1.9,
        "plain words": 0.0,
        "a b c bad ass": 1.5,
        "b c bad ass": -2.5,
        "x kind of good": 1.9 - 0.293,
        "kind of good": 1.9,
        "x just enough bad": -2.5 - 0.293,
        "oh yeah right good": -2.0,
        "of kiss of death": 0.0,
        "not the bomb good": 3.0,
    }
    got = scores(spark, lexicon, list(cases))
    for text, score in zip(cases, got):
        assert score == expected(cases[text]), text


def test_blank_reviews_are_neutral_and_kept(spark, lexicon):
    assert scores(spark, lexicon, [None, "", "   ", "zzz"]) == [50.0, 50.0, 50.0, 50.0]


def test_large_lexicons_are_shuffled_and_agree(spark, lexicon, monkeypatch):
    rng = random.Random(1)
    vocabulary = ["good", "bad", "no", "love", "but", "not", "very", "so", "never", "least", "kind", "of", "x", "bad ass", "the bomb", "great"]
    reviews = ["good but bad", None, "", "love no bad"] + [" ".join(rng.choices(vocabulary, k=rng.randint(0, 12))) for _ in range(150)]
    small = scores(spark, lexicon, reviews)
    monkeypatch.setattr(sentiment, "BROADCAST_ENTRIES", 2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert scores(spark, lexicon, reviews) == small
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_neighbours_with_a_value_of_their_own_do_not_act(spark):
    lexicon = literal_table(spark, "word string, valence double", [*LEXICON, ("very", 0.5), ("not", -0.7)])
    assert scores(spark, lexicon, ["not good", "very good", "not x good"]) == [expected(1.2), expected(1.9), expected(1.2)]


def test_aggregate(spark):
    df = spark.createDataFrame([(1, 50.0), (1, 70.5), (2, 10.0)], "recipeid long, sentiment_score double")
    got = {r.recipeid: tuple(r)[1:] for r in sentiment.aggregate_by_recipe(df).collect()}
    assert got == {1: (60.25, 2, 14.5), 2: (10.0, 1, 0.0)}


def test_percentile_matches_pandas(spark):
    values = [1.0, 1.0, 2.0, 3.0, 3.0, 3.0]
    df = spark.createDataFrame(list(enumerate(values)), "recipeid long, mean_sentiment_score double")
    got = sentiment.add_percentile_rank(df).orderBy("recipeid").toPandas()["sentiment_percentile"]
    assert list(got) == [25.0, 25.0, 50.0, 83.33, 83.33, 83.33]
    assert list(got) == list((pd.Series(values).rank(pct=True) * 100).round(2))


def test_incremental_scores_only_new_reviews(spark, lexicon):
    reviews = spark.createDataFrame(
        [(1, 1, "good"), (2, 1, "bad")], "reviewid long, recipeid long, review string"
    )
    old = spark.createDataFrame([(1, 1, 12.34)], "reviewid long, recipeid long, sentiment_score double")
    got = {r.reviewid: r.sentiment_score for r in sentiment.score_new_reviews(reviews, old, lexicon).collect()}
    assert got[1] == 12.34 and got[2] == expected(-2.5)


def test_one_shuffle_and_no_python(spark, lexicon):
    df = spark.createDataFrame([(1, 1, "good bad")], "id long, recipeid long, review string")
    text = plan(sentiment.score_reviews(df, lexicon, keys=("id", "recipeid")))
    assert text.count("Exchange hashpartitioning") == 1 and text.count("HashJoin") == 1
    assert "Python" not in text and "Window" not in text


def test_custom_rules(spark, lexicon):
    rules = SentimentRules(boosters_up=("muy",), boosters_down=(), negations=("nada",), contrast="pero")
    df = spark.createDataFrame([(1, 1, "muy good pero nada bad")], "reviewid long, recipeid long, review string")
    got = sentiment.score_reviews(df, lexicon, rules).first().sentiment_score
    assert got == expected((1.9 + 0.293) * 0.5 + -2.5 * -0.74 * 1.5)
