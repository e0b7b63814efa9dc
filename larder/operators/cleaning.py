"""Bronze to Silver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from larder import constants as K
from larder.functions import numeric, text
from larder.sources.schemas import LOAD_POSITION, lower_names, require_columns

RECIPE_TEXTS = ("name", "recipecategory", "recipeingredientparts", "recipeinstructions")
RECIPE_TIMES = ("cooktime", "preptime", "totaltime")
RECIPE_COLUMNS = (
    "recipeid", "name", *RECIPE_TIMES, "recipecategory", "recipeingredientparts",
    "aggregatedrating", "reviewcount", "recipeinstructions",
)
SEASONALITY_COLUMNS = (
    "product_name", "product_type", "month", "country", "source", "extracted_at",
)
PRODUCTION_NAMES = {
    "Area Code": "area_code", "Area": "country_name", "Item Code": "item_code",
    "Item": "product_name", "Element": "element", "Year": "year", "Unit": "unit",
    "Value": "production_value",
}


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in a total order.

    Catalyst limits each key to one row before the shuffle (WindowGroupLimit), so a key that
    holds a third of the rows costs one row per map task.
    """
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def all_columns_order(df: DataFrame, keys: list[str]) -> list[Column]:
    """A total order for tables that carry no load order."""
    return [F.col(f"`{c}`").asc_nulls_last() for c in df.columns if c not in keys]


def load_order(df: DataFrame, keys: list[str]) -> list[Column]:
    """The place a row was read from, where the reader kept it, then the columns."""
    place = [F.col(LOAD_POSITION).asc_nulls_last()] if LOAD_POSITION in df.columns else []
    return place + all_columns_order(df, [*keys, LOAD_POSITION])


def month_number(month: Column) -> Column:
    pairs = [F.lit(v) for pair in K.MONTHS.items() for v in pair]
    return F.try_element_at(F.create_map(*pairs), month)


def clean_recipes(bronze: DataFrame, order: list[Column] | None = None) -> DataFrame:
    df = lower_names(bronze)
    require_columns(df, list(RECIPE_COLUMNS))
    kept = first_per_key(df, ["recipeid"], order or load_order(df, ["recipeid"]))
    converted = {}
    for name in RECIPE_COLUMNS:
        column = F.col(name)
        if name in RECIPE_TEXTS:
            column = text.clean_text(column)
        elif name in RECIPE_TIMES:
            column = text.duration_minutes(column)
        elif name in ("aggregatedrating", "reviewcount"):
            column = numeric.number_or_zero(column)
        converted[name] = column
    return kept.select(
        *[column.alias(name) for name, column in converted.items()],
        F.current_timestamp().alias("processed_at"),
    )


def clean_reviews(bronze: DataFrame, order: list[Column] | None = None) -> DataFrame:
    df = lower_names(bronze)
    require_columns(df, ["reviewid", "recipeid", "rating", "review"])
    kept = first_per_key(df, ["reviewid"], order or load_order(df, ["reviewid"]))
    return kept.select(
        "reviewid",
        "recipeid",
        numeric.number_or_zero(F.col("rating")).alias("rating"),
        text.clean_text(F.col("review")).alias("review"),
        F.current_timestamp().alias("processed_at"),
    )


def clean_seasonality(bronze: DataFrame, order: list[Column] | None = None) -> DataFrame:
    require_columns(bronze, list(SEASONALITY_COLUMNS))
    texts = ("product_name", "product_type", "month", "country", "source")
    df = bronze.select(
        *[text.key_text(F.col(name)).alias(name) for name in texts],
        "extracted_at",
        *[c for c in bronze.columns if c == LOAD_POSITION],
    ).withColumn("month_number", month_number(F.col("month")))
    known = df.na.drop(subset=["product_name", "product_type", "month_number", "country"])
    keys = ["product_name", "product_type", "month_number", "country"]
    return first_per_key(known, keys, order or load_order(known, keys)).select(
        "product_name",
        "product_type",
        "month",
        F.col("month_number").cast("long").alias("month_number"),
        "country",
        F.lit(True).alias("is_in_season"),
        F.lit(1.0).alias("confidence_score"),
        "source",
        "extracted_at",
        F.current_timestamp().alias("processed_at"),
    )


def clean_production(bronze: DataFrame, order: list[Column] | None = None) -> DataFrame:
    require_columns(bronze, list(PRODUCTION_NAMES))
    df = bronze.where(F.col("Element") == "Production").select(
        *[F.col(f"`{old}`").alias(new) for old, new in PRODUCTION_NAMES.items()],
        *[c for c in bronze.columns if c == LOAD_POSITION],
    )
    for name in ("country_name", "product_name", "element", "unit"):
        df = df.withColumn(name, text.key_text(F.col(name)))
    df = (
        df.withColumn("year", numeric.number_or_null(F.col("year"), "long"))
        .withColumn("production_value", numeric.number_or_null(F.col("production_value")))
        .na.drop(subset=["country_name", "product_name", "year", "production_value"])
    )
    keys = ["area_code", "item_code", "year", "element"]
    return (
        first_per_key(df, keys, order or load_order(df, keys))
        .drop(LOAD_POSITION)
        .withColumn("source", F.lit("faostat_qcl"))
        .withColumn("processed_at", F.current_timestamp())
    )
