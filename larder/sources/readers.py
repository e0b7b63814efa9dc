"""Table readers."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from larder.functions import text
from larder.sources.schemas import LOAD_POSITION


def latest_snapshot_path(spark: SparkSession, directory: str, pattern: str) -> str:
    """Last path, by name, whose last part matches ``pattern``.

    One listing of ``directory`` itself: what lies below the snapshots is not looked at.
    """
    glob = f"{directory.rstrip('/')}/{pattern}"
    path = spark._jvm.org.apache.hadoop.fs.Path(glob)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    paths = [status.getPath() for status in found or ()]
    if not paths:
        raise FileNotFoundError(f"no snapshot matches {glob}")
    return max(paths, key=lambda p: p.getName()).toString()


def read_latest(
    spark: SparkSession, directory: str, pattern: str, schema: T.StructType | None = None
) -> DataFrame:
    path = latest_snapshot_path(spark, directory, pattern)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_parquet(
    spark: SparkSession, path: str, columns: list[str] | None = None
) -> DataFrame:
    """Parquet from any file system Spark can address; only ``columns`` are scanned."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_parquet_in_order(spark: SparkSession, path: str) -> DataFrame:
    """Parquet rows with their load position, so that "first" can mean first in file order."""
    place = F.struct(
        F.col("_metadata.file_path").alias("file"), F.lit(0).cast("long").alias("begin"), F.col("_metadata.row_index").alias("row")
    )
    df = spark.read.parquet(path)
    return df.select(*[F.col(f"`{c}`") for c in df.columns], place.alias(LOAD_POSITION))


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False
) -> DataFrame:
    """CSV with a header and quoted text, doubled quotes inside it.

    With ``multi_line`` quoted text may span lines; a file is then read by one task.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )


def read_recursive(spark: SparkSession, path: str, key: str) -> DataFrame:
    """All parquet files below ``path``, with the partition key taken from the file name."""
    return (
        spark.read.option("recursiveFileLookup", True)
        .parquet(path)
        .withColumn("file_name", F.col("_metadata.file_path"))
        .withColumn(key, F.regexp_extract("file_name", f"{key}=([^/]+)", 1))
    )


def read_country_month(spark: SparkSession, path: str, country: str, month: int) -> DataFrame:
    """Scores of one country and month: one partition directory is scanned."""
    df = spark.read.parquet(path).where(
        (text.country_key(F.col("score_country")) == text.country_key(F.lit(country)))
        & (F.col("score_month") == month)
    )
    if df.limit(1).isEmpty():
        raise LookupError(f"no scores for country {country!r}, month {month}")
    return df


def read_country_scores(
    spark: SparkSession, path: str, country: str, flat_path: str | None = None
) -> DataFrame:
    """Scores of one country; else a flat table filtered by country; else an empty table."""
    wanted = text.country_key(F.lit(country))
    schema = None
    for candidate in (path, flat_path):
        if candidate is None:
            continue
        try:
            df = spark.read.parquet(candidate)
        except AnalysisException:
            continue
        schema = df.schema
        rows = df.where(text.country_key(F.col("score_country")) == wanted)
        if not rows.limit(1).isEmpty():
            return rows
    if schema is None:
        raise FileNotFoundError("no score table found")
    return spark.createDataFrame([], schema)



def read_taxonomy(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """Ordered (term, category) pairs of a JSON object; empty when the file is missing.

    The file is configuration and is read whole. Its order decides the category of a name, and
    a key given twice keeps its first place and its last category.
    """
    try:
        found = spark.read.text(path, wholetext=True).head(2)
    except AnalysisException:
        return []
    if not found:
        return []
    if len(found) > 1:
        raise ValueError(f"{path} holds more than one taxonomy file")
    payload = json.loads(found[0][0])
    if isinstance(payload, dict) and "categories" in payload:
        payload = payload["categories"]
    if not isinstance(payload, dict):
        raise ValueError(f"taxonomy at {path} must be a JSON object")
    pairs = {str(k).strip().lower(): str(v).strip().lower() for k, v in payload.items()}
    return [(k, v) for k, v in pairs.items() if k]


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """(word, valence) of a tab-separated lexicon: word, mean, further columns ignored.

    A word given twice keeps its last entry, as the published reader does. Lines without a number
    in the second column are left out.
    """
    parts = F.split("value", "\t")
    entries = spark.read.text(path).select(
        F.monotonically_increasing_id().alias("line"),
        F.trim(F.get(parts, 0)).alias("word"),
        F.trim(F.get(parts, 1)).try_cast("double").alias("valence"),
    )
    known = entries.where((F.col("word") != "") & F.col("valence").isNotNull())
    return known.groupBy("word").agg(F.max_by("valence", "line").alias("valence"))


def taxonomy_table(texts: DataFrame) -> DataFrame:
    """Rows (pos, term, category) from JSON text, for taxonomies kept in a table."""
    parsed = texts.select(
        F.coalesce(
            F.from_json(F.get_json_object("value", "$.categories"), "map<string,string>"),
            F.from_json("value", "map<string,string>"),
        ).alias("m")
    )
    return (
        parsed.select(F.posexplode(F.map_entries("m")))
        .select(
            "pos",
            F.lower(F.trim("col.key")).alias("term"),
            F.lower(F.trim("col.value")).alias("category"),
        )
        .where(F.col("term") != "")
    )
