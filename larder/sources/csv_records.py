"""CSV with line breaks inside quoted text, read by many tasks a file, with inferred types.

A line break ends a record only outside quotes, so whether a byte range begins inside one depends on
all quotes before it. Ranges are read as lines by their own tasks; each range's number of quotes is
summed over the ranges of its file, which tells how every range begins, and from there every line
whether it begins a record. Records that fit in one line, nearly all, stay where they are; only the
lines of longer ones are exchanged.

Files follow RFC 4180: text that holds quotes, delimiters or line breaks is quoted, and quotes in it
are doubled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from larder.sources.schemas import LOAD_POSITION

_OPTIONS = {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}


def record_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, owner, ordinal, range, place, line, alone): lines with the record they belong to.

    A record is named by its file, the range that it begins in and its number there, from 1.
    ``alone`` says that the line is the whole record.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("range"),
        F.monotonically_increasing_id().alias("place"),
        F.col("value").alias("line"),
        F.regexp_count("value", F.lit('"')).alias("quotes"),
    )
    in_order = W.partitionBy("file", "range").orderBy("place")
    so_far = in_order.rowsBetween(W.unboundedPreceding, -1)
    # How each range begins, from the sums of the ranges before it: as many rows as ranges.
    ranges = lines.groupBy("file", "range").agg(F.sum("quotes").alias("quotes"))
    earlier = W.partitionBy("file").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    inside = (F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2).alias("inside")
    begins = ranges.select(F.col("file").alias("f"), F.col("range").alias("r"), inside)
    placed = lines.join(begins, (F.col("file") == F.col("f")) & (F.col("range") == F.col("r"))).drop("f", "r")
    open_quotes = F.col("inside") + F.coalesce(F.sum("quotes").over(so_far), F.lit(0))
    placed = placed.withColumn("first", open_quotes % 2 == 0).withColumn(
        "alone", F.col("first") & (F.col("quotes") % 2 == 0)
    )
    ordinal = F.sum(F.col("first").cast("long")).over(in_order.rowsBetween(W.unboundedPreceding, 0))
    placed = placed.withColumn("ordinal", ordinal)
    # A range that begins inside a record carries on the last record begun before it.
    counts = placed.groupBy("file", "range").agg(F.max("ordinal").alias("n"))
    last = F.last(F.when(F.col("n") > 0, F.struct(F.col("range").alias("owner"), F.col("n"))), ignorenulls=True)
    carried = counts.select(F.col("file").alias("f"), F.col("range").alias("r"), last.over(earlier).alias("before"))
    joined = placed.join(carried, (F.col("file") == F.col("f")) & (F.col("range") == F.col("r")))
    own = F.col("ordinal") > 0
    return joined.select(
        "file",
        F.when(own, F.col("range")).otherwise(F.col("before.owner")).alias("owner"),
        F.when(own, F.col("ordinal")).otherwise(F.col("before.n")).alias("ordinal"),
        "range",
        "place",
        "line",
        "alone",
    )


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, owner, ordinal, record): the text of each record; line breaks in quotes become a line feed."""
    lines = record_lines(spark, path)
    keys = ["file", "owner", "ordinal"]
    lines = lines.withColumn("line", F.regexp_replace("line", "\\r$", ""))
    single = lines.where("alone").select(*keys, F.col("line").alias("record"))
    parts = F.sort_array(F.collect_list(F.struct("range", "place", "line")))
    longer = lines.where(~F.col("alone")).groupBy(*keys).agg(parts.alias("parts")).select(
        *keys, F.array_join(F.transform("parts", lambda p: p["line"]), "\n").alias("record")
    )
    return single.unionByName(longer).where("record <> ''")


def _is_header() -> Column:
    return (F.col("owner") == 0) & (F.col("ordinal") == 1)


def read_csv_parallel(
    spark: SparkSession, path: str, schema: T.StructType | None = None, in_order: bool = False
) -> DataFrame:
    """Rows of CSV files with a header each; names come from the header and types from all values
    unless a schema is given, which goes by position.

    Empty unquoted values are null. Blank lines outside quotes are skipped. Files of no line, or of
    a header alone, have no rows. With ``in_order`` the place of each record is kept in a column, so
    that "first" can mean first in file order.
    """
    found = records(spark, path)
    if schema is None:
        header = found.where(_is_header()).orderBy("file").limit(1).collect()  # one record
        if not header:
            return spark.createDataFrame([], T.StructType())
        width = spark.createDataFrame([(header[0]["record"],)], "r string")
        names = _fields(width, "r", header[0]["record"].count(",") + 1).first()
        names = [n for n in names if n is not None]
        texts = T.StructType([T.StructField(n, T.StringType()) for n in names])
        rows = _parsed(found.where(~_is_header()), texts, in_order)
        return cast_to(rows, infer_types(rows.select(*[F.col(f"`{n}`") for n in names])))
    return _parsed(found.where(~_is_header()), schema, in_order)


def _fields(df: DataFrame, column: str, most: int) -> DataFrame:
    schema = ", ".join(f"c{i} string" for i in range(most))
    return df.select(F.from_csv(column, F.lit(schema), _OPTIONS).alias("v")).select("v.*")


def _parsed(found: DataFrame, schema: T.StructType, in_order: bool) -> DataFrame:
    # Names may clash or hold any character, so fields are parsed by position.
    plain = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(schema.fields))
    place = F.struct("file", F.col("owner").alias("begin"), F.col("ordinal").alias("row")).alias(LOAD_POSITION)
    values = found.select(F.from_csv("record", F.lit(plain), _OPTIONS).alias("v"), place)
    fields = [F.col(f"v.c{i}").alias(f.name) for i, f in enumerate(schema.fields)]
    return values.select(*fields, *([LOAD_POSITION] if in_order else []))


def _fits(value: Column) -> dict[str, Column]:
    """Whether a text is of a type, from the narrowest to the widest."""
    return {
        "bigint": value.rlike(r"^[+-]?[0-9]+$") & value.try_cast("bigint").isNotNull(),
        "double": value.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"),
        "boolean": F.lower(value).isin("true", "false"),
    }


def infer_types(texts: DataFrame) -> list[str]:
    """Narrowest type of each text column: bigint below double below string, boolean below string.

    One aggregate over all rows of flags that merge by "and", so every task's part counts. Nulls fit
    all types; a column without a value is text.
    """
    flags = []
    for i, name in enumerate(texts.columns):
        value = F.trim(F.col(f"`{name}`"))
        flags.append(F.count(value).alias(f"n{i}"))
        flags += [F.bool_and(F.when(value.isNotNull(), fits)).alias(f"{kind}{i}") for kind, fits in _fits(value).items()]
    found = texts.agg(*flags).first()
    return [
        next((kind for kind in _fits(F.lit("")) if found[f"n{i}"] and found[f"{kind}{i}"]), "string")
        for i in range(len(texts.columns))
    ]


def cast_to(texts: DataFrame, types: list[str]) -> DataFrame:
    """Text columns by position; further columns stay as they are."""
    rest = [F.col(f"`{c}`") for c in texts.columns[len(types) :]]
    return texts.select(*[
        F.col(f"`{name}`") if kind == "string" else F.trim(F.col(f"`{name}`")).try_cast(kind).alias(name)
        for name, kind in zip(texts.columns, types)
    ], *rest)
