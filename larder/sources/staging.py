"""Tables handed from one job to the next through the shared folder.

A staged table cuts lineage, survives the loss of executors, and gives Catalyst the real size
of an intermediate result. Joins on staged tables carry no broadcast hint: a side below
``spark.sql.autoBroadcastJoinThreshold`` is broadcast, any larger one is shuffled and its hot
keys are split by the adaptive skew-join rule.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

_local_dirs: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by the cluster.

    A local one serves only a local master that names none; any other session without a shared
    folder is refused, since its executors could not read each other's files.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="larder-")
        atexit.register(shutil.rmtree, _local_dirs[app], ignore_errors=True)
    return _local_dirs[app]


def new_path(spark: SparkSession, name: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/larder/{app}/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back with the same schema."""
    spark = df.sparkSession
    path = new_path(spark, name)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def literal_table(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """A table of constants from configuration."""
    names = [part.split()[0] for part in schema.split(",")]
    if not rows:
        return spark.createDataFrame([], schema)
    entries = F.array(
        *[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
    )
    table = spark.range(0, 1, 1, 1).select(F.explode(entries).alias("e")).selectExpr(
        *[f"cast(e.{p.split()[0]} as {p.split()[1]}) as {p.split()[0]}" for p in schema.split(",")]
    )
    return table
