"""Numeric column expressions and exact statistics.

Rounding is spelled out with ``floor`` so that every SQL engine gives the same digits, and
means of fractional values are taken over scaled integers so that a result does not depend on
the order in which partial sums arrive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

QUANTILE_ACCURACY = 100_000


def round_half_up(value: Column, places: int) -> Column:
    scale = float(10**places)
    return F.floor(value * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def scaled_long(value: Column, places: int) -> Column:
    """``value`` as a whole number of 10^-places units."""
    return F.floor(value * F.lit(float(10**places)) + F.lit(0.5)).cast("long")


def exact_total(units: Column) -> Column:
    """Sum of a long column as a decimal that does not overflow.

    The numbers are summed in three parts of 21 bits, as adding longs costs a row far less than
    adding decimals.
    """
    part = F.lit(2**21 - 1)
    low, middle, high = units.bitwiseAND(part), F.shiftright(units, 21).bitwiseAND(part), F.shiftright(units, 42)

    def weighed(bits: Column, power: int) -> Column:
        return F.sum(bits).cast("decimal(20,0)") * F.lit(2**power).cast("decimal(14,0)")

    return weighed(high, 42) + weighed(middle, 21) + weighed(low, 0)


def exact_mean(value: Column, places: int) -> Column:
    """Mean of a column that is meaningful to ``places`` decimals; order-independent."""
    units = scaled_long(value, places)
    total = exact_total(units).cast("double")
    return total / F.count(units) / F.lit(float(10**places))


def moments_stddev(n: Column, s1: Column, s2: Column, places: int) -> Column:
    """Sample deviation from a count and the sums of scaled whole numbers and of their squares."""
    n, s1, s2 = (c.cast("double") for c in (n, s1, s2))
    variance = F.when(n > 1, (s2 - s1 * s1 / n) / F.nullif(n - F.lit(1.0), F.lit(0.0)))
    return F.sqrt(F.greatest(variance, F.lit(0.0))) / F.lit(float(10**places))


def exact_stddev(value: Column, places: int) -> Column:
    """Sample deviation from exact integer moments; null for fewer than two rows."""
    units = scaled_long(value, places)
    wide = units.cast("decimal(19,0)")
    return moments_stddev(F.count(units), F.sum(wide), F.sum(wide * wide), places)


def number_or_zero(value: Column) -> Column:
    number = value.try_cast("double")
    return F.when(number.isNull() | F.isnan(number), F.lit(0.0)).otherwise(number)


def number_or_null(value: Column, data_type: str = "double") -> Column:
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number).try_cast(data_type)


def min_max(value: Column, low: Column, high: Column) -> Column:
    """Scale to [0, 1]; a constant column becomes 0, a null stays null."""
    return F.when(value.isNull(), F.lit(None).cast("double")).otherwise(
        F.coalesce(F.try_divide(value - low, high - low), F.lit(0.0))
    )


def column_bounds(df: DataFrame, columns: list[str]) -> Column:
    """One-row scalar subquery ``struct<c_lo, c_hi, ...>``: no window over the base rows."""
    parts = []
    for name in columns:
        parts += [F.min(name).alias(f"{name}_lo"), F.max(name).alias(f"{name}_hi")]
    return df.agg(F.struct(*parts).alias("bounds")).scalar()


def min_max_columns(df: DataFrame, columns: list[str], suffix: str = "_scaled") -> DataFrame:
    with_bounds = df.withColumn("_bounds", column_bounds(df, columns))
    for name in columns:
        with_bounds = with_bounds.withColumn(
            f"{name}{suffix}",
            min_max(F.col(name), F.col(f"_bounds.{name}_lo"), F.col(f"_bounds.{name}_hi")),
        )
    return with_bounds.drop("_bounds")


def exact_quantiles(df: DataFrame, wanted: list[tuple[str, float]]) -> DataFrame:
    """Exact linear-interpolated quantiles of several columns as a one-row frame ``(q0, q1, ...)``.

    ``percentile`` keeps every distinct value in one buffer. Here one pass brackets all wanted ranks
    with sketches of known rank error, and one more counts, for each, the rows below the bracket,
    the rows above it, and the distinct values inside; only those few values are ranked. Of the rows
    outside, the value next to the bracket is kept too, since a rank may lie one place beyond it.
    """
    slack = 2.0 / QUANTILE_ACCURACY
    columns = {f"v{i}": F.col(name).cast("double") for i, (name, _) in enumerate(wanted)}
    values = df.select(*[value.alias(name) for name, value in columns.items()])
    ends = []
    for i, (_, q) in enumerate(wanted):
        around = [max(0.0, q - slack), min(1.0, q + slack)]
        ends.append(F.percentile_approx(f"v{i}", around, QUANTILE_ACCURACY).alias(f"e{i}"))
    near = values.agg(F.struct(*ends).alias("near")).scalar()

    def place(i: int) -> Column:
        v, low, high = F.col(f"v{i}"), F.col(f"near.e{i}")[0], F.col(f"near.e{i}")[1]
        side = F.when(v < low, F.lit(-1)).when(v > high, F.lit(1)).otherwise(F.lit(0))
        return F.struct(F.lit(i).alias("i"), side.alias("side"), v.alias("v"))

    places = F.filter(F.array(*[place(i) for i in range(len(wanted))]), lambda p: p["v"].isNotNull())
    # Rows outside a bracket share one key for each side; they are counted map-side.
    counted = (
        values.withColumn("near", near)
        .select(F.inline(places))
        .groupBy("i", "side", F.when(F.col("side") == 0, F.col("v")).alias("inside"))
        .agg(F.count("*").alias("rows"), F.max("v").alias("most"), F.min("v").alias("least"))
        .withColumn("value", F.when(F.col("side") < 0, F.col("most")).otherwise(F.col("least")))
    )
    by_column = W.partitionBy("i")
    running = counted.withColumn("upto", F.sum("rows").over(by_column.orderBy("side", "value"))).withColumn(
        "n", F.sum("rows").over(by_column)
    )
    share = F.element_at(F.array(*[F.lit(float(q)) for _, q in wanted]), F.col("i") + 1)
    position = (F.col("n") - 1) * share
    ranked = running.groupBy("i").agg(
        F.min(F.when(F.col("upto") > F.floor(position), F.col("value"))).alias("lower"),
        F.min(F.when(F.col("upto") > F.ceil(position), F.col("value"))).alias("upper"),
        F.first(position - F.floor(position)).alias("share"),
    )
    found = F.col("lower") + (F.col("upper") - F.col("lower")) * F.col("share")
    return ranked.agg(*[F.max(F.when(F.col("i") == i, found)).alias(f"q{i}") for i in range(len(wanted))])


def exact_quantile(df: DataFrame, column: str, q: float) -> DataFrame:
    """One exact quantile as a one-row frame ``(quantile)``."""
    return exact_quantiles(df, [(column, q)]).select(F.col("q0").alias("quantile"))
