import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from larder.functions import numeric, text

TAXONOMY = [("apple", "fruit"), ("carrot", "vegetable"), ("chicken", "meat")]


def apply(spark, function, values, schema="v string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, " + schema)
    return [r[1] for r in df.select("i", function(F.col("v"))).orderBy("i").collect()]


def test_clean_text(spark):
    raw = ['c("Blueberries", "granulated sugar")', None, "  A_b~c!  d\n e ", "(x)", "café 5€"]
    assert apply(spark, text.clean_text, raw) == [
        "blueberries granulated sugar", "", "a b c d e", "x", "café 5€",
    ]


def test_duration(spark):
    raw = ["PT1H30M", "PT45M", "PT2H", "P1DT2H", "PT30S", None, "soon", "PT"]
    assert apply(spark, text.duration_minutes, raw) == [90, 45, 120, 0, 0, 0, 0, 0]


def test_key_text_keeps_null(spark):
    assert apply(spark, text.key_text, ["  Garlic  (Dry) ", None]) == ["garlic (dry)", None]


def test_word_count(spark):
    assert apply(spark, text.word_count, ["a  b\tc", "", "  ", None]) == [3, 0, 0, 0]


def test_usable_tokens(spark):
    raw = ["Garlic and garlic with 12 ab oil of ½ 100 tomatoes", None]
    assert apply(spark, text.usable_tokens, raw) == [["garlic", "oil", "tomatoes"], []]


@pytest.mark.parametrize(
    "token, term, expected",
    [
        ("pineapple", "apple", False),
        ("grapefruit", "grape", False),
        ("tomatoes", "tomato", True),
        ("garlic", "garlic (dry)", True),
        ("eggplant", "eggplants (aubergines)", True),
        ("glass", "gla", True),
        ("potato", "potatoes", True),
        ("rice", "(paddy)", False),
    ],
)
def test_word_family(spark, token, term, expected):
    df = spark.createDataFrame([(token, term)], "a string, b string")
    assert df.select(text.same_word_family(F.col("a"), F.col("b"))).first()[0] is expected


def test_reference_root(spark):
    terms = ["garlic (dry)", "eggplants (aubergines)", "tomato", "beer of barley", "(paddy) rice"]
    assert apply(spark, text.reference_root, terms) == ["garlic", "eggplants", "tomato", "beer", "rice"]


def brute_ngrams(value):
    out = []
    for word in value.lower().split():
        padded = f" {word} "
        for size in (3, 4):
            if len(padded) <= size:
                out.append(padded)
                break
            out += [padded[i : i + size] for i in range(len(padded) - size + 1)]
    return sorted(out)


def test_ngrams(spark):
    values = ["tomato", "a", "ab", "abc", "red onion", ""]
    got = apply(spark, text.padded_ngrams, values)
    assert [sorted(g) for g in got] == [brute_ngrams(v) for v in values]


def test_category_order_and_blank(spark):
    names = ["apple", "Red Apple (fresh)", "chick", "zzz", "carrots and apple", ""]
    got = apply(spark, lambda c: text.category_of(c, TAXONOMY), names)
    assert got == ["fruit", "fruit", "meat", "other", "fruit", "fruit"]


def test_country_names(spark):
    assert apply(spark, text.country_key, ["Czech Republic", " United Kingdom", "France"]) == [
        "czechrepublic", "unitedkingdom", "france",
    ]
    assert apply(spark, text.country_display, ["czechrepublic", "france"]) == ["Czech Republic", "France"]


def test_instruction_steps(spark):
    raw = ["Mix well. Bake! 2. Serve 3. eat", "one 1. two 2. three", " . ", None, ""]
    assert apply(spark, text.instruction_steps, raw) == [
        ["Mix well", "Bake!", "2", "Serve", "eat"], ["one", "two", "three"], ["."], [], [],
    ]


def test_singular_key(spark):
    raw = ["Berries", "potatoes", "carrots", "bass", "figs", "asparagus", "Garlic (dry)", None]
    assert apply(spark, text.singular_key, raw) == [
        "berry", "potato", "carrot", "bass", "figs", "asparagus", "garlic  dry", "",
    ]


def test_phrase_rewrite(spark):
    phrases = [("cream", "creme"), ("ice cream", "glace")]
    got = apply(spark, lambda c: text.rewrite_phrases(c, phrases), ["Ice Cream and  cream", "scream"])
    assert got == ["glace and creme", "scream"]


def test_step_rewrite_is_rejected_when_too_much_is_left(spark):
    steps = ["blend with ice until smooth", "serve cold"]
    got = apply(spark, lambda c: text.rewrite_step(c, [], [("serve", "servir"), ("cold", "froid")]), steps)
    assert got == ["blend with ice until smooth", "servir froid"]


def test_mixed_language(spark):
    rows = ["garnish with until", "le four est chaud et la pate est prete pour le plat", "", None]
    assert apply(spark, text.looks_mixed, rows) == [True, False, False, False]


def test_basket_hits_both_ways(spark):
    df = spark.createDataFrame([(["eggplants (aubergines)", "fig"],), (None,)], "a array<string>")
    got = [r[0] for r in df.select(text.basket_hits(F.col("a"), ["aubergine", "figs", "kiwi"])).collect()]
    assert got == [["aubergine", "figs"], []]


def test_rounding_is_half_up(spark):
    got = apply(spark, lambda c: numeric.round_half_up(c, 2), [0.125, 64.0, 2.344], "v double")
    assert got == [0.13, 64.0, 2.34]


def test_numbers(spark):
    assert apply(spark, numeric.number_or_zero, ["4.5", "x", None, "NaN"]) == [4.5, 0.0, 0.0, 0.0]
    assert apply(spark, numeric.number_or_null, ["4.5", "x", "NaN"]) == [4.5, None, None]


def test_min_max_constant_and_null(spark):
    df = spark.createDataFrame([(1.0, 5), (3.0, 5), (None, 5)], "a double, b int")
    rows = numeric.min_max_columns(df, ["a", "b"]).select("a_scaled", "b_scaled").collect()
    assert sorted(map(tuple, rows), key=str) == [(0.0, 0.0), (1.0, 0.0), (None, 0.0)]


@settings(max_examples=12, deadline=None)
@given(
    st.lists(st.one_of(st.none(), st.integers(-50, 50)), min_size=1, max_size=40),
    st.sampled_from([0.0, 0.5, 0.8, 0.99, 1.0]),
)
def test_exact_quantile_small(spark, values, q):
    got = numeric.exact_quantile(spark.createDataFrame([(v,) for v in values], "v int"), "v", q).first()[0]
    expected = pd.Series(values, dtype="float").quantile(q)
    assert (got is None and pd.isna(expected)) or got == pytest.approx(expected)


def test_exact_quantile_brackets_large_input(spark, monkeypatch):
    # A coarse sketch leaves a wide bracket; the answer must stay exact.
    monkeypatch.setattr(numeric, "QUANTILE_ACCURACY", 500)
    df = spark.range(20_001).select(((F.col("id") * 7919) % 20_001).cast("double").alias("v"))
    skewed = df.unionByName(spark.range(10_000).select(F.lit(5.0).alias("v")))
    local = skewed.toPandas()["v"]
    for q in (0.0, 0.2, 0.5, 0.8, 0.99, 1.0):
        assert numeric.exact_quantile(skewed, "v", q).first()[0] == pytest.approx(local.quantile(q))


def test_joint_quantiles_in_two_passes(spark, monkeypatch):
    monkeypatch.setattr(numeric, "QUANTILE_ACCURACY", 100)
    rng = np.random.default_rng(2)
    table = pd.DataFrame({"a": rng.integers(0, 40, 3000).astype(float), "b": rng.normal(size=3000), "c": np.full(3000, 2.0), "d": np.nan})
    table.loc[::7, "a"] = np.nan
    df = spark.createDataFrame([tuple(None if np.isnan(x) else float(x) for x in r) for r in table.to_numpy()], "a double, b double, c double, d double")
    wanted = [(c, q) for c in "abcd" for q in (0.0, 0.013, 0.5, 0.8, 0.99, 1.0)]
    got = numeric.exact_quantiles(df, wanted)
    for value, (c, q) in zip(got.first(), wanted):
        expected = table[c].quantile(q)
        assert (value is None and np.isnan(expected)) or value == pytest.approx(expected, abs=1e-12), (c, q)
    for n in range(1, 25):
        some = spark.range(n).select(F.col("id").cast("double").alias("v"))
        assert list(numeric.exact_quantiles(some, [("v", q / 10) for q in range(11)]).first()) == pytest.approx([(n - 1) * q / 10 for q in range(11)])
