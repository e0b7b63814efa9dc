import random

import pytest
from conftest import plan
from larder.operators import sentiment, sentiment_state
from larder.sources.staging import literal_table
from pyspark.sql import functions as F

BATCH = "reviewid long, recipeid long, review string, withdrawn boolean"
WORDS = ["good", "bad", "great", "no", "x", "but", "very"]


@pytest.fixture(scope="module")
def lexicon(spark):
    return literal_table(spark, "word string, valence double", [("good", 1.9), ("great", 3.1), ("bad", -2.5), ("no", -1.2)])


def full(spark, lexicon, reviews):
    rows = spark.createDataFrame([(i, *r) for i, r in reviews.items()], "reviewid long, recipeid long, review string")
    built = sentiment.aggregate_by_recipe(sentiment.score_reviews(rows, lexicon))
    return sorted(map(tuple, sentiment.add_percentile_rank(built).collect()), key=str)


def stored(spark, store):
    return sorted(map(tuple, sentiment_state.recipe_sentiment(spark, store).collect()), key=str)


def test_batches_equal_a_full_build(spark, lexicon, tmp_path):
    rng, store, reviews = random.Random(2), f"{tmp_path}/state", {}
    sentiment_state.create(spark, store)
    assert stored(spark, store) == []
    for size in (40, 25, 0):
        batch = []
        for i in rng.sample(range(60), size):
            recipe = rng.choice([None, 1, 2, 3, 4, 5])
            text = rng.choice([None, "", " ".join(rng.choices(WORDS, k=4))])
            gone = rng.choice([True, False, False, None])
            batch.append((i, recipe, text, gone))
            if gone:
                reviews.pop(i, None)
            else:
                reviews[i] = (recipe, text)
        sentiment_state.apply_batch(store, spark.createDataFrame(batch, BATCH), lexicon)
        assert stored(spark, store) == full(spark, lexicon, reviews)
    before = stored(spark, store)
    version = sentiment_state.compact(spark, store)
    assert sentiment_state.latest(spark, store) == (version, version) and stored(spark, store) == before
    gone = spark.createDataFrame([(i, None, None, True) for i in reviews], BATCH)
    sentiment_state.apply_batch(store, gone, lexicon)
    assert stored(spark, store) == []


def test_a_failed_batch_is_run_again(spark, lexicon, tmp_path, monkeypatch):
    store = f"{tmp_path}/state"
    sentiment_state.create(spark, store)
    batch = spark.createDataFrame([(1, 1, "good", None), (2, 1, "bad", None)], BATCH)
    write = sentiment_state._write

    def fails(df, store, table, version):
        if table == "histogram":
            raise OSError("lost")
        write(df, store, table, version)

    monkeypatch.setattr(sentiment_state, "_write", fails)
    with pytest.raises(OSError):
        sentiment_state.apply_batch(store, batch, lexicon)
    assert stored(spark, store) == [] and sentiment_state.latest(spark, store) == (0, 0)
    monkeypatch.setattr(sentiment_state, "_write", write)
    assert sentiment_state.apply_batch(store, batch, lexicon) == 1
    assert stored(spark, store) == full(spark, lexicon, {1: (1, "good"), 2: (1, "bad")})


def test_ranks_come_from_the_histogram(spark, lexicon, tmp_path):
    store = f"{tmp_path}/state"
    sentiment_state.create(spark, store)
    sentiment_state.apply_batch(store, spark.createDataFrame([(1, 1, "good", None)], BATCH), lexicon)
    text = plan(sentiment_state.recipe_sentiment(spark, store))
    assert text.count("hashpartitioning(recipeid") == 1 and "PartitionFilters: [isnotnull(version" in text
