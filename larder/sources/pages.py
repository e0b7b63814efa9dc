"""Tokens from the attributes of saved pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def attribute_values(html: Column, tag: str, attribute: str) -> Column:
    pattern = rf'<{tag}\b[^>]*\b{attribute}="([^"]*)"'
    return F.regexp_extract_all(html, F.lit(pattern), F.lit(1))


def attribute_tokens(
    pages: DataFrame, key: str, html: str, tag: str, attribute: str, separator: str
) -> DataFrame:
    """Rows (key, value, first, second) of attribute values with at least two parts."""
    parts = F.split("value", separator)
    return (
        pages.select(key, F.explode(attribute_values(F.col(html), tag, attribute)).alias("value"))
        .withColumn("parts", parts)
        .where(F.size("parts") > 1)
        .select(
            key, "value", F.col("parts")[0].alias("first"), F.col("parts")[1].alias("second")
        )
    )


def season_rows(pages: DataFrame, html: str, product_type: str, source: str) -> DataFrame:
    """Product, month and country rows of a produce grid.

    Each item is ``<div class="x month-country ...">...<strong>name</strong>``; the first class
    names the item, the others are its months. Classes without a hyphen are skipped.
    """
    pattern = r'<div\b[^>]*\bclass="([^"]*)"[^>]*>(?:(?!<div\b)[\s\S])*?<strong\b[^>]*>([\s\S]*?)</strong>'
    item = F.explode(
        F.arrays_zip(
            F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(1)).alias("classes"),
            F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(2)).alias("name"),
        )
    )
    tokens = pages.select(item.alias("item")).select(
        F.trim("item.name").alias("product_name"),
        F.explode(F.filter(F.split("item.classes", " "), lambda _, i: i > 0)).alias("token"),
    )
    return (
        tokens.withColumn("parts", F.split("token", "-"))
        .where(F.size("parts") > 1)
        .select(
            "product_name",
            F.lit(product_type).alias("product_type"),
            F.col("parts")[0].alias("month"),
            F.col("parts")[1].alias("country"),
            F.lit(source).alias("source"),
            F.current_timestamp().alias("extracted_at"),
        )
    )
