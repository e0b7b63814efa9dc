"""Rule-based review sentiment and its aggregation.

Words meet the lexicon in one join; what it does not know ends there. A hit takes the spelling of its
neighbours from the word array, and learns from the other hits of its review, in order of position,
which of them have a value themselves.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from larder import constants as K
from larder.functions import numeric, text

UNIT_PLACES = 9
#: Lexicon entries (a word and a number) that are broadcast; published lexicons have under 10,000.
BROADCAST_ENTRIES = 500_000
#: Words on either side of a hit that the rules look at.
WORDS_BEFORE, WORDS_BEHIND = 3, 2


@dataclass(frozen=True)
class SentimentRules:
    boosters_up: tuple[str, ...] = K.BOOSTERS_UP
    boosters_down: tuple[str, ...] = K.BOOSTERS_DOWN
    negations: tuple[str, ...] = K.NEGATIONS
    contrast: str = K.CONTRAST_WORD
    #: Phrases of two or three words that give a word in or after them a value of their own.
    idioms: tuple[tuple[str, float], ...] = K.IDIOMS
    #: Boosters of two or three words among the three before a word.
    phrase_boosters: tuple[tuple[str, float], ...] = K.PHRASE_BOOSTERS


@dataclass(frozen=True)
class Hit:
    """A word of the lexicon with what its neighbours' spelling says, before their own values are known."""

    words: Column
    at: Column
    valence: Column
    rules: SentimentRules
    #: Position of the first of ``words``, which may be only those around the hit.
    first: Column

    def word(self, distance: int) -> Column:
        """The word ``distance`` before this one (negative: behind); null beyond the text."""
        return F.get(self.words, self.at - self.first - F.lit(distance))

    def boost(self, distance: int) -> Column:
        word = self.word(distance)
        return (
            F.when(word.isin(*self.rules.boosters_up), F.lit(K.BOOST_UP))
            .when(word.isin(*self.rules.boosters_down), F.lit(K.BOOST_DOWN))
            .otherwise(F.lit(0.0))
        )

    def factor(self, distance: int) -> Column:
        word = F.coalesce(self.word(distance), F.lit(""))
        negated = word.isin(*self.rules.negations)
        if distance == 1:
            return F.when(negated, F.lit(K.NEGATION_FACTOR)).otherwise(F.lit(1.0))
        emphasis, doubt = F.lit(False), F.lit(False)
        for nearer in range(1, distance):
            between = F.coalesce(self.word(nearer), F.lit(""))
            emphasis = emphasis | between.isin("so", "this")
            doubt = doubt | (between == "doubt")
        return (
            F.when((word == "never") & emphasis, F.lit(K.NEVER_FACTOR))
            .when((word == "without") & doubt, F.lit(1.0))
            .when(negated, F.lit(K.NEGATION_FACTOR))
            .otherwise(F.lit(1.0))
        )

    def value(self) -> Column:
        w1, w2, w3 = (F.coalesce(self.word(d), F.lit("")) for d in (1, 2, 3))
        after_no = (w1 == "no") | (w2 == "no") | ((w3 == "no") & w1.isin("or", "nor"))
        return self.valence * F.when(after_no, F.lit(K.NEGATION_FACTOR)).otherwise(F.lit(1.0))

    def silent(self) -> Column:
        word = self.word(0)
        kind_of = (word == "kind") & (F.coalesce(self.word(-1), F.lit("")) == "of")
        return word.isin(*self.rules.boosters_up, *self.rules.boosters_down) | kind_of

    def least(self) -> Column:
        w1, w2 = (F.coalesce(self.word(d), F.lit("")) for d in (1, 2))
        return F.when((w1 == "least") & ~w2.isin("at", "very"), F.lit(K.NEGATION_FACTOR)).otherwise(F.lit(1.0))

    def contrast(self, contrast_at: Column) -> Column:
        return (
            F.when(self.at < contrast_at, F.lit(K.BEFORE_CONTRAST))
            .when(self.at > contrast_at, F.lit(K.AFTER_CONTRAST))
            .otherwise(F.lit(1.0))
        )

    def _listed(self, distances: tuple[int, ...], entries: tuple[tuple[str, float], ...]) -> Column:
        # Null when one of the words is missing. The table is a constant, so a phrase is spelled once.
        spaced = [part for d in distances for part in (F.lit(" "), self.word(d))][1:]
        table = F.create_map(*[F.lit(x) for text_, number in dict(entries).items() for x in (text_, float(number))])
        return F.try_element_at(table, F.concat(*spaced))

    def idiom(self) -> Column:
        """Value of the phrase around the word; of several that match, the one furthest ahead."""
        around = ((0, -1, -2), (0, -1), (1, 0), (2, 1, 0), (2, 1), (3, 2, 1), (3, 2))
        if not self.rules.idioms:
            return F.lit(None).cast("double")
        return F.coalesce(*[self._listed(d, self.rules.idioms) for d in around])

    def phrase_boosts(self) -> list[Column]:
        before = ((3, 2, 1), (3, 2), (2, 1)) if self.rules.phrase_boosters else ()
        return [F.coalesce(self._listed(d, self.rules.phrase_boosters), F.lit(0.0)) for d in before]

    def struct(self, contrast_at: Column) -> Column:
        fields = [self.at.alias("pos"), self.value().alias("value"), self.silent().alias("silent")]
        fields += [(self.word(0) == "no").alias("no"), self.least().alias("least")]
        fields += [self.contrast(contrast_at).alias("contrast"), self.idiom().alias("idiom")]
        for d in (1, 2, 3):
            fields += [self.boost(d).alias(f"boost{d}"), self.factor(d).alias(f"factor{d}")]
        fields += [F.coalesce(self.word(3).isNotNull(), F.lit(False)).alias("third")]
        fields += [extra.alias(f"extra{i}") for i, extra in enumerate(self.phrase_boosts())]
        return F.struct(*fields)


def adjusted_valence(hits: Column, hit: Column, index: Column, extras: int) -> Column:
    """Valence of a hit; neighbours that are hits of the same review neither boost nor negate it.

    ``hits`` is in order of position, so a hit up to three words before is one of the three entries
    before. Phrases count where the third word before exists and is no hit itself.
    """

    def is_hit(distance: int) -> Column:
        found = F.lit(False)
        for back in range(1, distance + 1) if distance > 0 else (-1,):
            other = F.get(hits, index - F.lit(back))["pos"]
            found = found | F.coalesce(other == hit["pos"] - F.lit(distance), F.lit(False))
        return found

    steps = F.array(*[
        F.struct(
            (hit[f"boost{d}"] * F.lit(K.DAMPING[d - 1])).alias("boost"),
            hit[f"factor{d}"].alias("factor"),
            is_hit(d).alias("idle"),
        )
        for d in (1, 2, 3)
    ])

    def step(value: Column, by: Column) -> Column:
        sign = F.when(value < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
        return F.when(by["idle"], value).otherwise((value + by["boost"] * sign) * by["factor"])

    value = F.aggregate(steps, hit["value"], step)
    phrased = F.coalesce(hit["idiom"], value)
    for i in range(extras):
        phrased = phrased + hit[f"extra{i}"]
    value = F.when(hit["third"] & ~is_hit(3), phrased).otherwise(value)
    value = value * F.when(is_hit(1), F.lit(1.0)).otherwise(hit["least"]) * hit["contrast"]
    return F.when(hit["silent"] | (hit["no"] & is_hit(-1)), F.lit(0.0)).otherwise(value)


def _words(reviews: DataFrame, keys: list[str], review: str, rules: SentimentRules) -> DataFrame:
    found = F.nullif(F.array_position("_words", rules.contrast), F.lit(0)) - 1
    rows = reviews.select(*keys, text.words(F.col(review)).alias("_words"))
    return rows.withColumn("_contrast_at", found)


def _hits_beside_words(reviews: DataFrame, entries: DataFrame, keys: list[str], rules: SentimentRules) -> DataFrame:
    """(keys, hits) with a lexicon that fits into every task: words that miss it end in the join.

    Of the word array that stays beside the exploded words, a hit takes the six words around it along.
    What they say is worked out behind the exchange: in the step that meets every word it would make
    the generated method too long to be compiled.
    """
    rows = reviews.select(*keys, "_words", "_contrast_at", F.posexplode_outer("_words").alias("_pos", "_word"))
    rows = rows.join(F.broadcast(entries), "_word", "left")
    # One row per review is kept, with a hit or without.
    rows = rows.where(F.col("_valence").isNotNull() | F.coalesce(F.col("_pos") == 0, F.lit(True)))
    first = F.greatest(F.col("_pos") - F.lit(WORDS_BEFORE), F.lit(0))
    around = F.slice("_words", first + F.lit(1), F.lit(WORDS_BEFORE + 1 + WORDS_BEHIND))
    found = F.struct("_pos", "_valence", "_contrast_at", first.alias("_first"), around.alias("_around"))
    rows = rows.select(*keys, F.when(F.col("_valence").isNotNull(), found).alias("_hit"))

    def with_context(f: Column) -> Column:
        return Hit(f["_around"], f["_pos"], f["_valence"], rules, f["_first"]).struct(f["_contrast_at"])

    grouped = rows.groupBy(*keys).agg(F.collect_list("_hit").alias("_found"))
    return grouped.select(*keys, F.sort_array(F.transform("_found", with_context)).alias("_hits"))


def _hits_shuffled(reviews: DataFrame, entries: DataFrame, keys: list[str], rules: SentimentRules) -> DataFrame:
    """(keys, hits) with a lexicon of any size: words travel without their text, which waits for its hits."""
    rows = reviews.select(*keys, F.posexplode("_words").alias("_pos", "_word")).join(entries, "_word")
    found = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_pos", "_valence"))).alias("_found"))
    sides = found.select(F.col("_found"), *[F.col(k).alias(f"_key_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    empty = F.array().cast("array<struct<_pos:int,_valence:double>>")

    def with_context(f: Column) -> Column:
        return Hit(F.col("_words"), f["_pos"], f["_valence"], rules, F.lit(0)).struct(F.col("_contrast_at"))

    joined = reviews.join(sides, same, "left")
    return joined.select(*keys, F.transform(F.coalesce("_found", empty), with_context).alias("_hits"))


def score_reviews(
    reviews: DataFrame,
    lexicon: DataFrame,
    rules: SentimentRules = SentimentRules(),
    keys: tuple[str, ...] = ("reviewid", "recipeid"),
    review: str = "review",
) -> DataFrame:
    """Score in [0, 100] per review; null or blank text scores exactly 50.

    Words meet the lexicon once. ``keys`` name a review; each word stands once in the lexicon. Up to
    ``BROADCAST_ENTRIES`` entries the lexicon is broadcast and only hits are exchanged, beyond that
    it is joined by word.
    """
    names = list(keys)
    entries = lexicon.select(
        F.col("word").alias("_word"), F.col("valence").cast("double").alias("_valence")
    ).where("_valence is not null")
    words = _words(reviews, names, review, rules)
    small = entries.limit(BROADCAST_ENTRIES + 1).count() <= BROADCAST_ENTRIES
    hits = (_hits_beside_words if small else _hits_shuffled)(words, entries, names, rules)
    extras = 3 if rules.phrase_boosters else 0

    def unit(hit: Column, index: Column) -> Column:
        return numeric.scaled_long(adjusted_valence(F.col("_hits"), hit, index, extras), UNIT_PLACES)

    units = F.aggregate(F.transform("_hits", unit), F.lit(0).cast("long"), lambda a, x: a + x)
    total = F.col("_units") / F.lit(float(10**UNIT_PLACES))
    compound = total / F.sqrt(total * total + F.lit(K.NORMALISE_ALPHA))
    return hits.withColumn("_units", units).select(
        *names, compound_to_score(numeric.round_half_up(compound, 4)).alias("sentiment_score")
    )


def compound_to_score(compound: Column) -> Column:
    """[-1, 1] to [0, 100] with two decimals."""
    return numeric.round_half_up((compound + F.lit(1.0)) / F.lit(2.0) * F.lit(100.0), 2)


def aggregate_by_recipe(scored: DataFrame) -> DataFrame:
    score = F.col("sentiment_score")
    return scored.groupBy("recipeid").agg(
        numeric.round_half_up(numeric.exact_mean(score, 2), 2).alias("mean_sentiment_score"),
        F.count(score).alias("review_count"),
        F.coalesce(
            numeric.round_half_up(numeric.exact_stddev(score, 2), 2), F.lit(0.0)
        ).alias("std_sentiment"),
    )


def add_percentile_rank(df: DataFrame, score: str = "mean_sentiment_score") -> DataFrame:
    """Average-tie percentile rank of a score that has two decimals in [0, 100].

    Scores are cut to that range and rounded to two decimals here, so at most 10,001 distinct
    ones are ranked in the ordered window whatever the number of rows.
    """
    key = numeric.round_half_up(F.least(F.greatest(F.col(score), F.lit(0.0)), F.lit(100.0)), 2)
    keyed = df.withColumn("_key", F.when(F.col(score).isNotNull(), key))
    counts = keyed.where(F.col("_key").isNotNull()).groupBy("_key").agg(F.count("*").alias("ties"))
    upto = F.sum("ties").over(W.orderBy("_key"))
    total = F.sum("ties").over(W.orderBy("_key").rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    rank = F.col("upto") - F.col("ties") + (F.col("ties") + 1) / F.lit(2.0)
    ranks = counts.withColumn("upto", upto).withColumn("total", total).select(
        "_key",
        numeric.round_half_up(rank / F.col("total") * F.lit(100.0), 2).alias(
            "sentiment_percentile"
        ),
    )
    return keyed.join(ranks, "_key", "left").select(*df.columns, "sentiment_percentile")


def distribution_summary(df: DataFrame) -> DataFrame:
    """Spread of the raw scores and of their percentiles in one row."""
    raw, pct = F.col("mean_sentiment_score"), F.col("sentiment_percentile")
    one = df.agg(
        numeric.exact_mean(raw, 2).alias("raw_mean"),
        numeric.exact_stddev(raw, 2).alias("raw_std"),
        numeric.exact_mean(pct, 2).alias("pct_mean"),
        numeric.exact_stddev(pct, 2).alias("pct_std"),
    )
    return one.select(
        numeric.round_half_up(F.col("raw_mean"), 2).alias("raw_mean"),
        numeric.round_half_up(F.col("raw_std"), 2).alias("raw_std"),
        numeric.round_half_up(F.col("pct_mean"), 2).alias("pct_mean"),
        numeric.round_half_up(F.col("pct_std"), 2).alias("pct_std"),
        numeric.round_half_up(
            F.try_divide(F.col("pct_std"), F.col("raw_std")), 2
        ).alias("spread_ratio"),
    )


def score_new_reviews(
    reviews: DataFrame,
    already_scored: DataFrame,
    lexicon: DataFrame,
    rules: SentimentRules = SentimentRules(),
) -> DataFrame:
    """Scores of all reviews, computing only those whose id was not scored before."""
    fresh = reviews.join(already_scored.select("reviewid"), "reviewid", "left_anti")
    return already_scored.select("reviewid", "recipeid", "sentiment_score").unionByName(
        score_reviews(fresh, lexicon, rules)
    )
