"""Table writers. None of them funnels a large table through one task."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F


def write_dated(df: DataFrame, directory: str, name: str, day: str | None = None) -> str:
    """Snapshot ``name_YYYYMMDD.parquet``; a second write on one day replaces the first."""
    day = day or datetime.now(timezone.utc).strftime("%Y%m%d")
    path = f"{directory.rstrip('/')}/{name}_{day}.parquet"
    df.write.mode("overwrite").parquet(path)
    return path


def write_parquet(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def files_per_country(spark: SparkSession) -> int:
    """Grows with the configured parallelism, so that a country never sits in a few tasks."""
    return max(8, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8)


def spread(df: DataFrame, key: str, by: tuple[str, ...]) -> DataFrame:
    """Rows of each ``key`` over several tasks.

    A hash of the row's own columns picks the task, so a retried task gets the same rows.
    """
    slot = F.pmod(F.xxhash64(*by), F.lit(files_per_country(df.sparkSession)))
    return df.repartition(key, slot)


def spread_keys(df: DataFrame, key: str, keys: list[str], by: tuple[str, ...], tasks: int) -> DataFrame:
    """Rows of each of the listed ``keys`` over ``tasks`` tasks, or as many as fill the cluster, of its own.

    The tasks are numbered and not drawn by a hash, so that no two share one; a hash of the row's own
    columns picks the one of its key, so a retried task gets the same rows.
    """
    parallelism = df.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, tasks, -(-parallelism // len(keys)))
    place = F.array_position(F.array(*[F.lit(k) for k in keys]), F.col(key)) - 1
    slot = F.pmod(F.xxhash64(*by), F.lit(tasks))
    return df.repartitionById(len(keys) * tasks, (place * tasks + slot).cast("int"))


def write_by_country(
    df: DataFrame,
    path: str,
    key: str = "score_country",
    order: tuple[str, ...] = ("score_month",),
    only_present: bool = False,
) -> str:
    """One directory per country, each file ordered for row-group pruning.

    ``df`` should already be spread by country (see ``spread``), at the point where it has the
    fewest rows. ``only_present`` replaces just the countries in ``df``.
    """
    (
        df.sortWithinPartitions(key, *order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if only_present else "static")
        .partitionBy(key)
        .parquet(path)
    )
    return path


def write_csv(df: DataFrame, path: str) -> str:
    """Report as CSV with a header; text is quoted so that it survives a read."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("quoteAll", True)
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def write_sql_model(spark: SparkSession, query: str, path: str) -> str:
    """Run a SQL model and keep its rows as parquet at ``path``."""
    return write_parquet(spark.sql(query), path)


def write_sample(df: DataFrame, path: str, key: str, rows: int = 100) -> str:
    """First rows by key as CSV."""
    return write_csv(df.orderBy(key).limit(rows), path)
