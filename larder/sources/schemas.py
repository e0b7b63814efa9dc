"""Column contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

#: Column that readers add on demand: file, begin of the byte range, place in it. Its order is that
#: of the rows in their files.
LOAD_POSITION = "load_position"

BRONZE_RECIPES = T.StructType(
    [T.StructField("RecipeId", T.LongType())]
    + [
        T.StructField(name, T.StringType())
        for name in (
            "Name", "CookTime", "PrepTime", "TotalTime", "RecipeCategory",
            "RecipeIngredientParts",
        )
    ]
    + [
        T.StructField("AggregatedRating", T.DoubleType()),
        T.StructField("ReviewCount", T.DoubleType()),
        T.StructField("RecipeInstructions", T.StringType()),
    ]
)

BRONZE_REVIEWS = T.StructType(
    [
        T.StructField("ReviewId", T.LongType()),
        T.StructField("RecipeId", T.LongType()),
        T.StructField("Rating", T.DoubleType()),
        T.StructField("Review", T.StringType()),
    ]
)

BRONZE_SEASONALITY = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("product_name", "product_type", "month", "country", "source", "extracted_at")
    ]
)

BRONZE_PRODUCTION = T.StructType(
    [
        T.StructField("Area Code", T.LongType()),
        T.StructField("Area", T.StringType()),
        T.StructField("Item Code", T.LongType()),
        T.StructField("Item", T.StringType()),
        T.StructField("Element", T.StringType()),
        T.StructField("Year", T.StringType()),
        T.StructField("Unit", T.StringType()),
        T.StructField("Value", T.StringType()),
    ]
)


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` itself, or an error that lists the missing columns."""
    missing = missing_columns(df, names)
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def missing_columns(df: DataFrame, names: list[str]) -> list[str]:
    return sorted(set(names) - set(df.columns))


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.lower() for name in df.columns])
