"""Quality rules: robust multivariate outliers per language and source, DataFrame functions only.

Each document is counted once into a narrow table. Its transformed statistic vector is judged by
the Mahalanobis distance to a minimum-covariance-determinant estimate of its group: starting from
medians and quartiles, each concentration step keeps the share ``SUPPORT`` of the group's rows
with the smallest distance and takes their mean and covariance, until nothing changes, at most
``MAX_STEPS`` times.

A step is one aggregation to (group, distance bin) with the moments of each bin, so a group of
any size costs a bounded number of rows per map task, and the wanted share is read off the
cumulated bins: it is met to the width of a bin (2 % in squared distance), from above. Moments are
exact integer sums, so results do not depend on partitioning or on retried tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from larder.sources.staging import stage

SPACE = r"[\x20\x09-\x0D]+"
#: Base rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Share of a group's rows that an estimate rests on, and rows a group must have for its own estimate.
SUPPORT = 0.75
MIN_GROUP = 100
#: Chance that a normal vector is rejected.
REJECT = 1e-6
MAX_STEPS = 8
#: Standard deviation added to each coordinate: no rejection over differences smaller than a few of these.
#: The largest value of a coordinate, ``LARGEST``, must lie beyond sqrt(``CUTOFF``) of them, or its statistic
#: could never reject a document.
FLOOR = {"length": 0.10, "symbols": 0.60, "dup_lines": 0.14, "repeats": 0.07}
LARGEST = {"length": math.inf, "symbols": math.inf, "dup_lines": 1.0, "repeats": MAX_REPEAT_PERCENT / 100}
DIMS = tuple(FLOOR)
#: Vectors are held as multiples of 1 / SCALE.
SCALE = 10_000
_BINS = 50


def text_statistics(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """Columns n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_lines added to ``docs``.

    A null text counts as empty. n_repeat_words counts the words that lie in a three-word window
    found at least twice in the text. Windows are compared by a 64-bit hash of their words.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    df = docs.withColumns(
        {
            "__words": F.filter(F.split(trimmed, SPACE), lambda w: w != ""),
            "__lines": lines,
            "n_symbols": F.char_length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long"),
        }
    )
    words, lines = F.col("__words"), F.col("__lines")
    n = F.size(words)
    grams = F.when(
        n >= 3,
        F.transform(
            F.slice(words, F.lit(1), F.greatest(n - 2, F.lit(0))),
            lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)),
        ),
    )
    df = df.withColumns(
        {
            "n_words": n.cast("long"),
            "word_chars": F.aggregate(words, F.lit(0).cast("long"), lambda a, w: a + F.char_length(w)),
            "n_lines": F.size(lines).cast("long"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            "__grams": grams,
        }
    ).drop("__words", "__lines")
    grams = F.col("__grams")
    # Only a text with a repeated window is sorted.
    placed = F.when(
        F.size(F.array_distinct(grams)) < F.size(grams),
        F.array_sort(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i")))),
    )
    df = df.withColumn("__placed", placed).drop("__grams")
    placed = F.col("__placed")
    again = F.filter(
        placed,
        lambda x, i: F.coalesce(F.get(placed, i - 1)["g"] == x["g"], F.lit(False))
        | F.coalesce(F.get(placed, i + 1)["g"] == x["g"], F.lit(False)),
    )
    covered = F.aggregate(
        F.array_sort(F.transform(again, lambda x: x["i"])),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda a, p: F.struct(
            (a["n"] + p + 3 - F.greatest(a["end"], p)).cast("long").alias("n"), (p + 3).alias("end")
        ),
        lambda a: a["n"],
    )
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("__placed")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def _vector() -> dict[str, Column]:
    """Coordinates of a document that passed the base rules, as scaled integers."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    values = {
        "length": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / words),
        "symbols": F.log1p(100 * F.col("n_symbols") / words),
        "dup_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeats": F.col("n_repeat_words") / words,
    }
    return {k: F.round(v * SCALE).cast("long") for k, v in values.items()}


def _chi2_cdf(d: int, x: float) -> float:
    """For an even number of degrees of freedom."""
    term = total = 1.0
    for k in range(1, d // 2):
        term *= x / 2 / k
        total += term
    return 1 - math.exp(-x / 2) * total


def _chi2_tail(d: int, p: float) -> float:
    """The x beyond which the chance is p."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if 1 - _chi2_cdf(d, mid) > p else (low, mid)
    return high


CUTOFF = _chi2_tail(len(DIMS), REJECT)
#: Makes the covariance of the kept share consistent for a normal distribution.
CONSISTENCY = SUPPORT / _chi2_cdf(len(DIMS) + 2, _chi2_tail(len(DIMS), 1 - SUPPORT))


def _with_groups(stats: DataFrame) -> DataFrame:
    """Adds ``grp``: language and source; the rest of the language where such a group is small;
    the rest of the corpus where that is small too. Null is a language and a source of its own."""
    own = F.to_json(F.struct("lang", "source"), {"ignoreNullFields": "false"})
    wide = F.to_json(F.struct("lang"), {"ignoreNullFields": "false"})
    sizes = stats.where(~F.col("base_failed")).groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    rest = F.sum(F.when(F.col("n") < MIN_GROUP, F.col("n")).otherwise(0)).over(W.partitionBy("lang"))
    # Written, so that Catalyst knows how few groups there are before wide rows move.
    named = stage(
        sizes.withColumn("rest", rest).select(
            F.col("lang").alias("__lang"),
            F.col("source").alias("__source"),
            F.when(F.col("n") >= MIN_GROUP, own)
            .when(F.col("rest") >= MIN_GROUP, wide)
            .otherwise(F.lit("{}"))
            .alias("grp"),
        ),
        "groups",
    )
    return stats.join(
        named,
        stats["lang"].eqNullSafe(F.col("__lang")) & stats["source"].eqNullSafe(F.col("__source")),
        "left",
    ).drop("__lang", "__source")


def _factored(moments: DataFrame, consistency: float) -> DataFrame:
    """(grp, m_i, l_ij) from the columns n, s_i, s_ij of each group."""
    d = range(len(DIMS))
    n = F.col("n").cast("double")
    mean = [F.col(f"s{i}").cast("double") / n / SCALE for i in d]
    cov = [
        [
            (F.col(f"s{max(i, j)}{min(i, j)}").cast("double") / n / SCALE / SCALE - mean[i] * mean[j]) * consistency
            + (FLOOR[DIMS[i]] ** 2 if i == j else 0.0)
            for j in d
        ]
        for i in d
    ]
    df = moments.select("grp", *[mean[i].alias(f"m{i}") for i in d], *[cov[i][j].alias(f"c{i}{j}") for i in d for j in d if j <= i])
    done: dict[tuple[int, int], Column] = {}
    for i in d:  # one projection a row, so that no expression is spelt out again and again
        new = {}
        for j in range(i + 1):
            rest = F.col(f"c{i}{j}")
            for k in range(j):
                rest = rest - (new[f"l{i}{k}"] if f"l{i}{k}" in new else F.col(f"l{i}{k}")) * (
                    new[f"l{j}{k}"] if f"l{j}{k}" in new else F.col(f"l{j}{k}")
                )
            new[f"l{i}{j}"] = F.sqrt(F.greatest(rest, F.lit(1e-9))) if i == j else rest / done[j, j]
            done[i, j] = F.col(f"l{i}{j}")
        df = df.withColumns(new)
    return df.drop(*[f"c{i}{j}" for i in d for j in d if j <= i])


def _distance() -> Column:
    """Squared Mahalanobis distance from the columns of ``_factored``."""
    z: list[Column] = []
    for i, name in enumerate(DIMS):
        rest = F.col(name) / SCALE - F.col(f"m{i}")
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * z[k]
        z.append(rest / F.col(f"l{i}{i}"))
    total = z[0] * z[0]
    for x in z[1:]:
        total = total + x * x
    return total


def _start(vectors: DataFrame) -> DataFrame:
    """Medians, and quartile ranges as scales, from counts of hundredths."""
    step = SCALE // 100
    cells = vectors.select(
        "grp",
        F.explode(
            F.array(*[F.struct(F.lit(i).alias("i"), F.round(F.col(c) / step).cast("long").alias("at")) for i, c in enumerate(DIMS)])
        ).alias("x"),
    )
    counts = cells.groupBy("grp", "x.i", "x.at").agg(F.count(F.lit(1)).alias("n"))
    over = W.partitionBy("grp", "i")
    ranked = counts.withColumn("upto", F.sum("n").over(over.orderBy("at"))).withColumn("all", F.sum("n").over(over))
    quartile = lambda q: F.min(F.when(F.col("upto") >= q * F.col("all"), F.col("at"))) / 100
    each = ranked.groupBy("grp", "i").agg(
        quartile(0.5).alias("m"), ((quartile(0.75) - quartile(0.25)) / 1.349).alias("s")
    )
    one = lambda c, i: F.max(F.when(F.col("i") == i, F.col(c)))
    d = range(len(DIMS))
    return each.groupBy("grp").agg(
        *[one("m", i).alias(f"m{i}") for i in d],
        *[F.sqrt(one("s", i) * one("s", i) + FLOOR[DIMS[i]] ** 2).alias(f"l{i}{i}") for i in d],
        *[F.lit(0.0).alias(f"l{i}{j}") for i in d for j in range(i)],
    )


def _concentrated(vectors: DataFrame, estimate: DataFrame) -> DataFrame:
    """Moments of each group's nearest rows under ``estimate``: one aggregation by bin."""
    d = range(len(DIMS))
    wide = [F.col(c).cast("decimal(18,0)") for c in DIMS]
    binned = (
        vectors.join(estimate, "grp")
        .withColumn("bin", F.floor(F.log(_distance() + 1e-4) * _BINS))
        .groupBy("grp", "bin")
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.sum(wide[i]).alias(f"s{i}") for i in d],
            *[F.sum((wide[i] * wide[j]).cast("decimal(28,0)")).alias(f"s{i}{j}") for i in d for j in range(i + 1)],
        )
    )
    over = W.partitionBy("grp")
    inside = (
        binned.withColumn("before", F.sum("n").over(over.orderBy("bin")) - F.col("n"))
        .withColumn("all", F.sum("n").over(over))
        .where(F.col("before") < SUPPORT * F.col("all"))
    )
    sums = ["n", *[f"s{i}" for i in d], *[f"s{i}{j}" for i in d for j in range(i + 1)]]
    return inside.groupBy("grp").agg(*[F.sum(c).alias(c) for c in sums])


def estimates(vectors: DataFrame) -> DataFrame:
    """(grp, m_i, l_ij): centre and Cholesky factor of each group's scatter.

    The steps stop when no group's moments change, at the latest after ``MAX_STEPS``: rows at the
    edge of a bin can go to and fro for ever, which hardly moves the estimate.
    """
    current, before = stage(_start(vectors), "mcd-start"), None
    moments = None
    for _ in range(MAX_STEPS):
        moments = stage(_concentrated(vectors, current), "mcd-step")
        now = moments.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*moments.columns).cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
        current = _factored(moments, 1.0)
    return stage(_factored(moments, CONSISTENCY), "mcd")


def judge(docs: DataFrame) -> DataFrame:
    """``docs`` columns doc_id, lang, source with counts, base_failed, distance and kept.

    One row for each row of ``docs``; repeated rows stay. A null text is empty and fails the base
    rules. distance is null for rows that fail them; kept is false for them, and otherwise
    distance <= ``CUTOFF``. Groups under ``MIN_GROUP`` rows are judged with the rest of their
    language, or of the corpus. An empty table gives an empty result.
    """
    counted = text_statistics(docs.select("doc_id", "text", "lang", "source")).drop("text")
    vectors = _vector()
    counted = counted.withColumn("base_failed", base_failed()).withColumns(vectors)
    stats = stage(counted, "statistics")
    grouped = _with_groups(stats)
    passed = grouped.where(~F.col("base_failed")).select("grp", *DIMS)
    return (
        grouped.join(estimates(passed), "grp", "left")
        .withColumn("distance", F.when(~F.col("base_failed"), _distance()))
        .withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= CUTOFF, F.lit(True)))
        .select(
            "doc_id",
            "lang",
            "source",
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            "n_lines",
            "base_failed",
            "distance",
            "kept",
        )
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with its columns.

    Rows are judged where they stand: their counts are taken again beside the text and compared
    with the estimates of their group, so that texts are never shuffled and repeated rows need no key.
    """
    names = docs.columns
    work = docs.withColumn("__row", F.struct(*[F.col(f"`{c}`") for c in names])).select(
        "__row", F.col("__row.text").alias("text"), F.col("__row.lang").alias("lang"), F.col("__row.source").alias("source")
    )
    counted = text_statistics(work).drop("text").withColumn("base_failed", base_failed()).withColumns(_vector())
    stats = stage(counted, "statistics")
    grouped = _with_groups(stats)
    found = estimates(grouped.where(~F.col("base_failed")).select("grp", *DIMS))
    kept = grouped.where(~F.col("base_failed")).join(found, "grp", "left").where(
        F.coalesce(_distance() <= CUTOFF, F.lit(True))
    )
    return kept.select(*[F.col("__row")[c].alias(c) for c in names])


def op4_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return judge(docs).drop("lang", "source")
