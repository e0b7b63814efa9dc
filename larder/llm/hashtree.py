"""Sharding by a hierarchical weighted hash tree.

A row descends from the root through regions and racks to a shard. At each node every child draws
``ln(u) / weight`` with u in (0, 1) from a hash of the row's id and the child's name, and the largest
draw wins: children win in proportion to their weights, and when a weight changes, only draws of
that child change. Rows therefore move only into or out of the subtrees whose weights changed.

A shard added later stands in a region of its own (``grow``). Then the weights of all other
subtrees stay as they are, and rows move into the new shard only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from larder.sources.staging import stage

SEED = 9
REGION_SHARDS, RACK_SHARDS = 20, 4
#: Rows numbered by one task.
SLOT_ROWS = 100_000


@dataclass(frozen=True)
class Leaf:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def tree(shards: int, region_shards: int = REGION_SHARDS, rack_shards: int = RACK_SHARDS) -> tuple[Leaf, ...]:
    """Equal shards 0.. in racks and regions filled in order."""
    return tuple(Leaf(s // region_shards, s // rack_shards, s) for s in range(shards))


def grow(leaves: Sequence[Leaf], weight: float = 1.0) -> tuple[Leaf, ...]:
    """One more shard, in a rack and a region of its own."""
    region, rack, shard = (1 + max(getattr(x, k) for x in leaves) for k in ("region", "rack", "shard"))
    return (*leaves, Leaf(region, rack, shard, weight))


def _draw(key: Column, level: str, name: int, weight: float, seed: int) -> Column:
    """ln(u) / weight with u from the upper 52 bits of a hash."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(f"{seed}:{level}:{name}"), key), 12)
    return F.log((bits.cast("double") + 0.5) / F.lit(float(1 << 52))) / F.lit(float(weight))


def _winner(key: Column, level: str, children: dict[int, float], seed: int) -> Column:
    """Name of the child with the largest draw; ties go to the smaller name."""
    if len(children) == 1:
        return F.lit(next(iter(children)))
    draws = [
        F.struct(_draw(key, level, name, weight, seed).alias("d"), F.lit(-name).alias("n"))
        for name, weight in children.items()
    ]
    return -F.array_max(F.array(*draws))["n"]


def with_shard(df: DataFrame, key: Column, leaves: Sequence[Leaf], name: str = "shard", seed: int = SEED) -> DataFrame:
    """``df`` with the shard of each row. Leaves of weight 0 get no rows; a null key is a key."""
    leaves = [x for x in leaves if x.weight > 0]
    if not leaves:
        raise ValueError("a tree needs a shard of positive weight")
    text = F.coalesce(key.cast("string"), F.lit("null"))
    sums: dict[str, dict[int, dict[int, float]]] = {"region": {}, "rack": {}, "shard": {}}
    for x in leaves:
        for level, parent, child in (("region", 0, x.region), ("rack", x.region, x.rack), ("shard", x.rack, x.shard)):
            level_sums = sums[level].setdefault(parent, {})
            level_sums[child] = level_sums.get(child, 0.0) + x.weight
    at = f"__{name}"
    df = df.withColumn(at, F.lit(0))
    for level in ("region", "rack", "shard"):
        choice = None
        for parent, children in sums[level].items():
            won = _winner(text, level, children, seed)
            choice = F.when(F.col(at) == parent, won) if choice is None else choice.when(F.col(at) == parent, won)
        df = df.withColumn(at, choice)
    return df.withColumnRenamed(at, name)


def with_slot(df: DataFrame, key: str, group: str = "shard", slot_rows: int = SLOT_ROWS) -> DataFrame:
    """Numbers 0.. within each group, without a group in one task.

    Rows of a group are dealt to buckets by a hash of row and key; buckets are numbered by their
    counts and rows inside their bucket. ``df`` must be a written table of narrow rows.
    """
    rows = df.agg(F.count(F.lit(1))).first()[0]
    buckets = max(1, math.ceil(rows / slot_rows))
    placed = df.withColumn("__bucket", F.pmod(F.xxhash64(F.lit("slot"), *df.columns), F.lit(buckets)).cast("int"))
    counts = placed.groupBy(group, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    before = counts.select(
        F.col(group).alias("__g"),
        F.col("__bucket").alias("__b"),
        (F.sum("__n").over(W.partitionBy(group).orderBy("__bucket")) - F.col("__n")).alias("__before"),
    )
    inside = F.row_number().over(W.partitionBy(group, "__bucket").orderBy(key, *[c for c in df.columns if c != key]))
    numbered = placed.withColumn("__inside", inside)
    return (
        numbered.join(before, (F.col(group) == F.col("__g")) & (F.col("__bucket") == F.col("__b")))
        .withColumn("slot", (F.col("__before") + F.col("__inside") - 1).cast("long"))
        .drop("__g", "__b", "__before", "__inside", "__bucket")
    )


def assign(docs: DataFrame, leaves: Sequence[Leaf], seed: int = SEED) -> DataFrame:
    """doc_id, size, text_crc32, shard, grown_shard, slot for every row of ``docs``.

    The id and the tree decide the shard, so repeated rows share one and have slots of their own. A
    null text counts as empty (size 16, checksum 0). Texts stay in the scan's task.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    narrow = with_shard(narrow, F.col("doc_id"), leaves, "shard", seed)
    narrow = with_shard(narrow, F.col("doc_id"), grow(leaves), "grown_shard", seed)
    return with_slot(stage(narrow, "shards"), "doc_id")


def op9_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return assign(docs, tree(40)).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
