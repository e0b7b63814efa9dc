"""Bounded Arrow batches for operators that take whole texts into Python."""

from __future__ import annotations

from pyspark.sql import SparkSession

BATCH_BYTES = 8 << 20
_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch to ``BATCH_BYTES``; a smaller setting of the user stays.

    A batch is held several times over in a Python worker (Arrow, pandas, results), so its size
    and not its number of rows must be bounded when texts can be long.
    """
    text = spark.conf.get(_SETTING).lower().rstrip("b")
    units = {"k": 10, "m": 20, "g": 30}
    now = int(text[:-1]) << units[text[-1]] if text[-1] in units else int(text)
    if now > BATCH_BYTES:
        spark.conf.set(_SETTING, str(BATCH_BYTES))
