import math
from collections import Counter

import pytest

from pyspark.sql import functions as F

from conftest import plan
from larder.operators import matching
from test_functions import brute_ngrams

TAXONOMY = [("tomato", "vegetable"), ("straw", "fruit"), ("salt", "condiment"), ("garlic", "vegetable")]
SEASON = ["tomato", "strawberry", "potato", "carrot", "garlic", "apple"]
PRODUCTION = ["tomato", "garlic (dry)", "cherries, sour", "apple", "rice"]
PARTS = [
    "tomatoes garlic and 12 pineapple tomato", "strawberries of zz", "", None, "xylophone rice rices",
]


def names(spark, values):
    return spark.createDataFrame([(v,) for v in values], "product_name string")


@pytest.fixture(scope="module")
def recipes(spark):
    return spark.createDataFrame(list(enumerate(PARTS)), "recipeid long, recipeingredientparts string")


@pytest.fixture(scope="module")
def matches(spark, recipes):
    return matching.match_ingredients(recipes, names(spark, SEASON), names(spark, PRODUCTION), TAXONOMY).cache()


def brute_best(tokens):
    terms = sorted(set(SEASON)) + sorted(set(PRODUCTION) - set(SEASON))
    counts = [Counter(brute_ngrams(t)) for t in terms]
    df = Counter(g for c in counts for g in c)
    idf = {g: math.log((1 + len(terms)) / (1 + n)) + 1 for g, n in df.items()}

    def vector(count):
        raw = {g: (1 + math.log(n)) * idf[g] for g, n in count.items() if g in idf}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        return {g: x / norm for g, x in raw.items()}

    vectors = [vector(c) for c in counts]
    out = {}
    for token in tokens:
        v = vector(Counter(brute_ngrams(token)))
        found = [round(sum(v[g] * r.get(g, 0) for g in v), 10) for r in vectors]
        best = max(range(len(terms)), key=lambda i: (found[i], -i))
        out[token] = (terms[best], round(found[best], 4))
    return out


def test_vocabulary_priority(spark):
    got = {r.term: r.source for r in matching.build_vocabulary(names(spark, SEASON), names(spark, PRODUCTION)).collect()}
    assert got["tomato"] == "eufic" and got["rice"] == "faostat"
    assert len(got) == len(set(SEASON) | set(PRODUCTION))


def test_tokens(recipes):
    got = sorted(r[0] for r in matching.distinct_tokens(recipes).collect())
    assert got == ["garlic", "pineapple", "rice", "rices", "strawberries", "tomato", "tomatoes", "xylophone"]


def test_cosine_matches_brute_force(spark, recipes):
    vocabulary = matching.build_vocabulary(names(spark, SEASON), names(spark, PRODUCTION))
    index = matching.ngram_index(vocabulary)
    tokens = matching.distinct_tokens(recipes)
    got = {r.ingredient_token: (r.best_term, r.similarity_score)
           for r in matching.match_tokens(tokens, vocabulary, index).collect()}
    for token, (term, score) in brute_best(got).items():
        assert got[token][0] == term and got[token][1] == pytest.approx(score, abs=1e-4), token


def test_decisions(matches):
    got = {r.ingredient_token: r for r in matches.collect()}
    assert (got["tomatoes"].matched_term, got["tomatoes"].source) == ("tomato", "eufic")
    assert (got["garlic"].matched_term, got["garlic"].source) == ("garlic", "eufic")
    assert (got["rices"].matched_term, got["rices"].source) == ("rice", "faostat")
    assert got["pineapple"].matched_term is None and got["pineapple"].revoked
    assert (got["xylophone"].similarity_score, got["xylophone"].source) == (0.0, "unmatched")
    report = matching.match_report(matches).first()
    assert report.eufic + report.faostat + report.unmatched == report.tokens == 8


def test_recipe_map(recipes, matches):
    got = {r.recipeid: r for r in matching.recipe_map(recipes, matches).collect()}
    assert len(got) == len(PARTS)
    # Two tokens of one term keep both entries, in token order.
    assert got[0].matched_ingredients == ["tomato", "garlic", "tomato"]
    assert got[0].ingredient_categories == ["vegetable"] * 3
    assert got[0].seasonal_ingredients == ["tomato", "garlic", "tomato"]
    assert (got[0].eufic_match_count, got[0].unmatched_count) == (3, 1)
    assert got[4].complementary_ingredients == ["rice", "rice"]
    assert got[2].matched_ingredients == [] and got[3].unmatched_count == 0


def test_detailed_matches(spark, recipes, matches):
    known = matches.where("ingredient_token <> 'tomato'")
    got = matching.recipe_ingredient_matches(recipes, known).where("ingredient_token = 'tomato'").first()
    assert (got.source, got.matched_term, got.ingredient_category) == ("unmatched", None, "other")
    coverage = matching.match_coverage(matching.recipe_map(recipes, matches)).first()
    # The plural of strawberry fails the word-family guard.
    assert tuple(coverage) == (2, 5)


def test_plan_has_no_cross_join(spark, recipes, matches):
    text = plan(matching.recipe_map(recipes, matches))
    assert "CartesianProduct" not in text and "NestedLoop" not in text and "Python" not in text


def test_hot_ngrams_are_sliced_without_loss(spark, monkeypatch):
    terms = [f"tomato{i}" for i in range(40)] + ["garlic"]
    tokens = spark.createDataFrame([(t,) for t in ("tomato7", "tomatoes", "garlik", "zz")], "ingredient_token string")
    vocabulary = matching.build_vocabulary(names(spark, terms), names(spark, []))
    index = matching.ngram_index(vocabulary)

    def best():
        return sorted(map(tuple, matching.match_tokens(tokens, vocabulary, index).collect()))

    whole = best()
    monkeypatch.setattr(matching, "SLICE_TERMS", 3)
    assert best() == whole
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert best() == whole
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def every_pair(vectors, index):
    return matching.full_scores(
        vectors.join(index.select("term", "ngram"), "ngram").select("ingredient_token", "term").distinct(), vectors, index
    )


def test_bounds_rule_out_most_of_a_large_vocabulary(spark):
    """100,000 terms: the best of all pairs is found, among few of them."""
    part = lambda salt, n: F.substring(F.translate(F.hex(F.xxhash64("id", F.lit(salt))), "0123456789ABCDEF", "aeioulnrstdmpkgb"), 1, n)
    words = spark.range(100_000).select(F.concat_ws(" ", part(1, 6), F.when(F.col("id") % 3 == 0, part(2, 5))).alias("product_name"), "id")
    vocabulary = matching.stage(matching.build_vocabulary(words.where("id % 2 = 0"), words.where("id % 2 = 1")), "v")
    index = matching.stage(matching.ngram_index(vocabulary), "i")
    close = words.where("id % 2500 = 0").select(F.concat(F.substring("product_name", 2, 9), F.lit("s")).alias("ingredient_token"))
    far = spark.range(20).select(part(5, 7).alias("ingredient_token"))
    odd = spark.createDataFrame([("zz",), ("éé",), ("",)], "ingredient_token string")
    tokens = matching.stage(close.union(far).union(odd).distinct(), "t")
    bounds = matching.ngram_bounds(index)
    vectors = matching.stage(matching.token_vectors(tokens, bounds), "w")
    whole = matching.stage(every_pair(vectors, index), "all")
    some = matching.candidate_terms(vectors, index, bounds)
    assert some.count() * 10 < whole.count()
    order = F.struct((-matching.numeric.round_half_up(F.col("dot"), 10)).alias("s"), "priority", "term")
    want = {r[0]: (r[1].term, -r[1].s) for r in whole.groupBy("ingredient_token").agg(F.min(order)).collect()}
    got = {r.ingredient_token: r for r in matching.match_tokens(tokens, vocabulary, index).collect()}
    assert len(got) == tokens.count() and len(want) > 50
    for token, r in got.items():
        term, score = want.get(token, (None, 0.0))
        assert term in (None, r.best_term) and r.similarity_score == pytest.approx(score, abs=1e-4), token
