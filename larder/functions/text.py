"""Text column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from larder import constants as K


#: ASCII punctuation and white space but the blank, for a character class; single characters make it one lookup.
_BREAKS = r"""!"#$%&'()*+,\-./:;<=>?@\[\\\]^_`{|}~\t\n\x0B\f\r"""


def collapse_blanks(value: Column) -> Column:
    return F.regexp_replace(value, r"\s+", " ")


def strip_blanks(value: Column) -> Column:
    return F.regexp_replace(value, r"^\s+|\s+$", "")


def clean_text(value: Column) -> Column:
    """Lower-case words separated by single blanks; vector literals and punctuation removed.

    One pass finds the opening of a vector literal, and runs of blanks and punctuation; a lone blank
    between two words is left as it is. The closing bracket is one of those runs, unless a line end
    that is no blank may follow it.
    """
    text = F.lower(F.coalesce(value, F.lit("")))
    line_ends = text.contains("\u0085") | text.contains("\u2028") | text.contains("\u2029")
    text = F.when(line_ends, F.regexp_replace(strip_blanks(text), r"\)$", "")).otherwise(text)
    return F.trim(F.regexp_replace(text, rf"^\s*c\s*\(|[{_BREAKS}][{_BREAKS} ]*| [{_BREAKS} ]+", " "))


def key_text(value: Column) -> Column:
    """Lower-case join key with single blanks; punctuation kept, null stays null."""
    return F.lower(F.trim(collapse_blanks(value.cast("string"))))


def duration_minutes(value: Column) -> Column:
    """Hours and minutes of an ISO-8601 duration; anything else counts as zero."""
    pattern = r"^PT(?:(\d+)H)?(?:(\d+)M)?"

    def part(index: int) -> Column:
        # A missing part is no number, and a cast that fails costs more than all the rest.
        digits = F.nullif(F.regexp_extract(value, pattern, index), F.lit(""))
        return F.coalesce(digits.try_cast("long"), F.lit(0))

    return part(1) * F.lit(60) + part(2)


def words(value: Column) -> Column:
    """Whitespace-separated words; an empty array for null or blank text."""
    text = strip_blanks(F.coalesce(value, F.lit("")))
    empty = F.array().cast("array<string>")
    return F.when(text == "", empty).otherwise(F.split(text, r"\s+"))


def word_count(value: Column) -> Column:
    return F.size(words(value))


def usable_tokens(value: Column) -> Column:
    """Distinct lower-case words without stop words, numbers and short words."""

    def keep(token: Column) -> Column:
        return (
            ~token.isin(*K.STOP_WORDS)
            & ~token.rlike(r"^\p{N}+$")
            & (F.length(token) >= K.MIN_TOKEN_LENGTH)
        )

    return F.array_distinct(F.filter(words(F.lower(value)), keep))


def name_key(value: Column) -> Column:
    """Lower-case name with round brackets turned into blanks."""
    text = F.trim(collapse_blanks(F.lower(value)))
    return F.trim(F.translate(text, "()", "  "))


def singular_key(value: Column) -> Column:
    """Comparison key of an option name: common English plurals removed."""
    text = name_key(F.coalesce(value, F.lit("")))
    long_enough = F.length(text) > 4

    def without(count: int) -> Column:
        return F.substring(text, F.lit(1), F.length(text) - F.lit(count))

    return (
        F.when(long_enough & text.endswith("ies"), F.concat(without(3), F.lit("y")))
        .when(long_enough & text.endswith("oes"), without(2))
        .when(long_enough & text.endswith("s") & ~text.rlike("(ss|us|is|os|as)$"), without(1))
        .otherwise(text)
    )


def reference_root(term: Column) -> Column:
    """First word of a reference term once bracketed qualifiers are dropped."""
    bare = F.trim(F.regexp_replace(term, r"\s*\(.*?\)", ""))
    return F.when(bare == "", F.split(F.trim(term), r"\s+")[0]).otherwise(
        F.split(bare, r"\s+")[0]
    )


def same_word_family(token: Column, term: Column) -> Column:
    """True when the token equals the root, its plural, or differs by a short ending."""
    root = reference_root(term)
    gap = F.length(token) - F.length(root)

    def without_s(value: Column) -> Column:
        return F.regexp_replace(value, "s+$", "")

    return (
        (token == root)
        | (without_s(token) == without_s(root))
        | (token.startswith(root) & (gap <= 2))
        | (root.startswith(token) & (gap >= -2))
    )


def padded_ngrams(value: Column) -> Column:
    """Character n-grams inside each blank-padded word.

    A padded word shorter than n gives no n-gram of that size; one that is not longer than
    the smallest size gives itself.
    """

    def of_word(word: Column, size: int, smallest: bool) -> Column:
        padded = F.concat(F.lit(" "), word, F.lit(" "))
        last = F.length(padded) - F.lit(size - 1)
        grams = F.transform(
            F.sequence(F.lit(1), F.greatest(last, F.lit(1))),
            lambda start: F.substring(padded, start, F.lit(size)),
        )
        if smallest:
            return grams
        return F.when(last >= 1, grams).otherwise(F.array().cast("array<string>"))

    per_word = F.transform(
        words(F.lower(value)),
        lambda word: F.concat(
            *[of_word(word, n, n == min(K.NGRAM_SIZES)) for n in K.NGRAM_SIZES]
        ),
    )
    return F.flatten(per_word)


def category_of(name: Column, taxonomy: list[tuple[str, str]]) -> Column:
    """Category of a name: exact key, else the first key contained either way, else other.

    ``taxonomy`` is configuration, so it becomes one array literal and the lookup stays a
    row-local expression: no join and no shuffle.
    """
    if not taxonomy:
        return F.lit(K.OTHER_CATEGORY)
    key = name_key(name)
    entries = F.array(
        *[F.struct(F.lit(t).alias("term"), F.lit(c).alias("category")) for t, c in taxonomy]
    )
    exact = F.filter(entries, lambda e: e["term"] == key)
    near = F.filter(entries, lambda e: e["term"].contains(key) | key.contains(e["term"]))
    return F.coalesce(
        F.try_element_at(exact, F.lit(1))["category"],
        F.try_element_at(near, F.lit(1))["category"],
        F.lit(K.OTHER_CATEGORY),
    )


def country_key(value: Column) -> Column:
    """Internal key of a displayed country: lower case, no blanks."""
    return F.replace(F.trim(F.lower(value)), F.lit(" "), F.lit(""))


def country_display(value: Column) -> Column:
    """Displayed form of an internal key; compound keys get their blank back."""
    spelled = value
    for key, name in K.COMPOUND_COUNTRIES.items():
        spelled = F.when(value == key, F.lit(name)).otherwise(spelled)
    return F.initcap(spelled)


def instruction_steps(value: Column) -> Column:
    """Steps split after sentence ends or at `n.` numbering; the whole text if none is left."""
    text = strip_blanks(F.coalesce(value, F.lit("")))
    pieces = F.transform(
        F.split(text, r"(?<=[.!?])\s+|\s+\d+\.\s+"),
        lambda step: F.regexp_replace(step, r"^[ .]+|[ .]+$", ""),
    )
    steps = F.filter(pieces, lambda step: step != "")
    empty = F.array().cast("array<string>")
    return (
        F.when(text == "", empty).when(F.size(steps) == 0, F.array(text)).otherwise(steps)
    )


def rewrite_phrases(value: Column, phrases: list[tuple[str, str]]) -> Column:
    """Replace whole-word phrases in any case, longest first, one after the other."""
    text = value
    for source, target in sorted(phrases, key=lambda pair: -len(pair[0])):
        pattern = r"(?i)\b" + re.escape(source) + r"\b"
        text = F.regexp_replace(text, F.lit(pattern), F.lit(target.replace("$", r"\$")))
    return F.trim(collapse_blanks(text))


def marker_count(value: Column, markers: tuple[str, ...]) -> Column:
    pattern = r"\b(" + "|".join(sorted(set(markers))) + r")\b"
    return F.regexp_count(F.lower(value), F.lit(pattern))


def rewrite_step(
    value: Column, phrases: list[tuple[str, str]], terms: list[tuple[str, str]]
) -> Column:
    """Rewrite a step, but keep the original when too many source-language words remain."""
    rewritten = rewrite_phrases(rewrite_phrases(value, phrases), terms)
    return F.when(
        marker_count(rewritten, K.STEP_MARKERS) > K.MAX_STEP_MARKERS, value
    ).otherwise(rewritten)


def looks_mixed(value: Column) -> Column:
    """True for text that still holds many source-language words."""
    markers = marker_count(value, K.MIXED_MARKERS)
    total = F.regexp_count(value, F.lit(r"\b[a-zA-Z]+\b"))
    share = F.coalesce(F.try_divide(markers.cast("double"), total.cast("double")), F.lit(0.0))
    return F.coalesce(
        (markers >= K.MIXED_MIN_MARKERS) | (share > K.MIXED_MIN_SHARE), F.lit(False)
    )


def basket_hits(ingredients: Column, basket: list[str]) -> Column:
    """Basket terms found in an ingredient, or containing one; empty for a null array."""
    terms = F.array(*[F.lit(b) for b in sorted(set(basket))]).cast("array<string>")
    known = F.coalesce(ingredients, F.array().cast("array<string>"))
    return F.filter(
        terms, lambda b: F.exists(known, lambda i: i.contains(b) | b.contains(i))
    )
