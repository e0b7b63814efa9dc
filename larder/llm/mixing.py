"""Mixing sources to target weights by temperature, realised as budgeted block permutations.

A source with token share q gets the weight q**a / sum(q**a). The exponent a is found by cutting
its bracket again and again until the weights meet a target entropy or a repetition limit; every
trial is an aggregate over the table of source totals, which stays distributed.

With a token budget B a source is read B * weight / tokens times. A whole number of passes (blocks)
covers all its documents; the last block is cut where the budget ends. Each block is a permutation
of its own: documents ordered by a hash of seed, block, and id. A block's cut is one threshold on
that hash, found from token sums per hash range and then inside a single range, so rows are
repeated or left out where they stand, and neither texts nor ids of a hot source are shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from larder.sources.staging import stage

#: No source is read more often than this many times as often as the one read least.
MAX_REPETITION = 2.0
SEED = 20
#: Hash ranges per block in which token sums are taken before the cut is sought.
RANGES = 1 << 12
_TRIALS, _ROUNDS = 16, 10


def tokens_of(text: Column) -> Column:
    """Words between ASCII white space; 0 for null. The cost unit of shares and budgets."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, r"[\x20\x09-\x0D]+"))).cast("long")


def source_totals(docs: DataFrame) -> DataFrame:
    """(source, tokens, rows): null is a source of its own; sources without a token are left out."""
    return (
        docs.groupBy("source")
        .agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
        .where("tokens > 0")
    )


def _trial(totals: DataFrame, exponents: list[float], total: int) -> dict[float, tuple[float, float]]:
    """{exponent: (entropy of the weights in nats, largest over smallest repetition)}"""
    q = F.col("tokens") / F.lit(float(total))
    tried = totals.select(q.alias("q"), F.explode(F.array(*[F.lit(float(a)) for a in exponents])).alias("a"))
    p = F.pow("q", F.col("a"))
    passes = F.pow("q", F.col("a") - 1)
    rows = (
        tried.groupBy("a")
        .agg(
            F.sum(p).alias("z"),
            F.sum(p * F.col("a") * F.log("q")).alias("e"),
            (F.max(passes) / F.min(passes)).alias("r"),
        )
        .collect()
    )
    return {r["a"]: (math.log(r["z"]) - r["e"] / r["z"], r["r"]) for r in rows}


def find_exponent(totals: DataFrame, entropy: float | None = None, repetition: float | None = MAX_REPETITION) -> float:
    """The exponent in 0..1 closest to even weights that the targets allow.

    Entropy of the weights falls and the repetition ratio falls as the exponent rises. With
    ``repetition``: the smallest exponent whose ratio is within the limit. With ``entropy`` (nats):
    the largest exponent whose weights still have that entropy; 0 where even equal weights lack it,
    1 where the shares themselves have it. If both are given the repetition limit prevails.
    """
    total = totals.agg(F.sum("tokens")).first()[0]
    if not total:
        return 1.0

    def section(low_side) -> float:
        """Boundary between exponents for which ``low_side`` holds and those above."""
        low, high = 0.0, 1.0
        seen = _trial(totals, [low, high], total)
        if not low_side(seen[low]):
            return low
        if low_side(seen[high]):
            return high
        for _ in range(_ROUNDS):
            grid = [low + (high - low) * i / _TRIALS for i in range(_TRIALS + 1)]
            seen = _trial(totals, grid[1:-1], total)
            last = max([i for i in range(1, _TRIALS) if low_side(seen[grid[i]])], default=0)
            low, high = grid[last], grid[last + 1]
            if high - low < 1e-9:
                break
        return (low + high) / 2

    found = []
    if repetition is not None:
        found.append(section(lambda x: x[1] > repetition))
    if entropy is not None:
        found.append(section(lambda x: x[0] >= entropy))
    return max(found, default=1.0)


def weights(totals: DataFrame, exponent: float, budget: int | None = None) -> DataFrame:
    """``totals`` with weight, budget (tokens of the source to emit) and passes.

    Without ``budget`` the whole corpus is the least to be emitted: the source read least often is
    read exactly once, so no document is left out.
    """
    total = totals.agg(F.sum("tokens").alias("t"))
    q = F.col("tokens") / F.col("t")
    raised = totals.join(F.broadcast(total)).withColumn("raised", F.pow(q, F.lit(exponent)))  # one row
    norm = raised.agg(F.sum("raised").alias("z"), F.max(F.col("tokens") / F.col("raised")).alias("most"))
    both = raised.join(F.broadcast(norm))  # one row
    # tokens / raised is largest for the source read least often, whose budget is its own tokens.
    whole = F.col("most") * F.col("raised") if budget is None else F.lit(float(budget)) * F.col("raised") / F.col("z")
    rounded = F.ceil(whole - 1e-6 * F.greatest(whole, F.lit(1.0)) / 1e3).cast("long")
    return both.select(
        "source",
        "tokens",
        "rows",
        (F.col("raised") / F.col("z")).alias("weight"),
        (F.greatest(rounded, F.col("tokens")) if budget is None else rounded).alias("budget"),
    ).withColumn("passes", F.col("budget") / F.col("tokens"))


def _perm(block: Column, seed: int) -> Column:
    """A document's place in a block's permutation, as an unsigned 62-bit number."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), block, F.coalesce(F.col("doc_id"), F.lit(-1).cast("long"))), 2)


def plan(docs: DataFrame, exponent: float | None = None, entropy: float | None = None, repetition: float | None = MAX_REPETITION, budget: int | None = None, seed: int = SEED) -> DataFrame:
    """Per source: tokens, rows, weight, budget, passes, full blocks, and the cut of the last block.

    ``docs`` has doc_id, source and tokens. A document belongs to the last block when its place
    is at most the cut: the places whose tokens before them are under the rest of the budget.
    Rows of one id share a place and stay together.
    """
    totals = stage(source_totals(docs), "source-totals")
    if exponent is None:
        exponent = find_exponent(totals, entropy, repetition)
    wanted = stage(
        weights(totals, exponent, budget)
        .withColumn("full", F.floor(F.col("budget") / F.col("tokens")).cast("int"))
        .withColumn("rest", F.col("budget") - F.col("full") * F.col("tokens")),
        "source-weights",
    )
    placed = docs.join(
        wanted.where("rest > 0").select(F.col("source").alias("s"), "full", "rest"),
        F.col("source").eqNullSafe(F.col("s")),
    ).select("s", "rest", "tokens", _perm(F.col("full"), seed).alias("place"))
    width = (1 << 62) // RANGES
    placed = placed.withColumn("range", F.floor(F.col("place") / F.lit(width)).cast("int"))
    sums = placed.groupBy("s", "rest", "range").agg(F.sum("tokens").alias("n"))
    upto = F.sum("n").over(W.partitionBy("s").orderBy("range"))
    edge = sums.withColumn("before", upto - F.col("n")).where("before < rest and before + n >= rest")
    inside = placed.select("s", "range", "place", "tokens").join(
        edge.select(F.col("s").alias("es"), F.col("range").alias("er"), "rest", "before"),
        F.col("s").eqNullSafe(F.col("es")) & (F.col("range") == F.col("er")),
    )
    # Places of equal ids are summed first, so the window holds one row a place.
    places = inside.groupBy("es", "rest", "before", "place").agg(F.sum("tokens").alias("n"))
    taken = F.col("before") + F.sum("n").over(W.partitionBy("es").orderBy("place")) - F.col("n")
    cuts = (
        places.withColumn("taken", taken).where("taken < rest").groupBy("es").agg(F.max("place").alias("cut"))
    )
    # Written, so that Catalyst knows how few sources there are before documents move.
    return stage(wanted.join(cuts, F.col("source").eqNullSafe(F.col("es")), "left").drop("es"), "mix-plan")


def realise(docs: DataFrame, planned: DataFrame, seed: int = SEED) -> DataFrame:
    """``docs`` rows repeated as planned, with ``block``, ``place`` and ``progress`` added.

    Order by progress (0..1) reads all sources at their weights throughout, each source block
    after block, and inside a block in the order of its permutation. Rows of sources without a
    token stay once, since they cost nothing.
    """
    chosen = planned.select(
        F.col("source").alias("__source"), F.col("full").alias("__full"), F.col("cut").alias("__cut"), F.col("passes").alias("__passes")
    )
    joined = docs.join(chosen, F.col("source").eqNullSafe(F.col("__source")), "left")
    full = F.coalesce("__full", F.lit(1))
    last = F.coalesce(_perm(F.col("__full"), seed) <= F.col("__cut"), F.lit(False)).cast("int")
    copies = full + last
    blocks = F.when(copies > 0, F.sequence(F.lit(0), F.greatest(copies - 1, F.lit(0))))
    out = joined.withColumn("block", F.explode(blocks))
    place = _perm(F.col("block"), seed)
    return (
        out.withColumn("place", place)
        .withColumn(
            "progress",
            F.least((F.col("block") + F.col("place") / F.lit(float(1 << 62))) / F.coalesce("__passes", F.lit(1.0)), F.lit(1.0)),
        )
        .drop("__source", "__full", "__cut", "__passes")
    )


def mix(docs: DataFrame, **targets) -> DataFrame:
    """The rows of ``docs`` mixed to temperature weights, with its columns.

    ``targets`` as for ``plan``. By default every row comes at least once and none more than
    ``MAX_REPETITION`` times (rounded up). A null source is a source; a null id has one place in
    each block; empty tables give an empty result.
    """
    names = docs.columns
    narrow = stage(docs.select("doc_id", "source", tokens_of(F.col("text")).alias("tokens")), "mix-tokens")
    return realise_columns(docs, plan(narrow, **targets), names)


def realise_columns(docs: DataFrame, planned: DataFrame, names: list[str]) -> DataFrame:
    held = docs.select("doc_id", "source", F.struct(*[F.col(f"`{c}`") for c in names]).alias("__row"))
    return realise(held, planned).select(*[F.col("__row")[c].alias(c) for c in names])


def op3_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    narrow = stage(docs.select("doc_id", "source", tokens_of(F.col("text")).alias("tokens")), "mix-tokens")
    return realise(narrow, plan(narrow))
