"""Hard negatives by slot-decomposed selection.

An anchor's positives are its best rows of the same label. Every positive sets a window of scores
in which a row of another label is a hard negative: near the positive, but not so near that it may
be a positive with a wrong label. The windows of one anchor overlap, so they are not searched one
by one. Their upper limits cut the scores into disjoint slots, and each row falls into one slot.
Blocks keep the best k rows of a slot, the exchange keeps the best k of all blocks, and a window's
answer is the descending merge of the slots from its own limit downwards: whatever the number of
windows, a row is looked at once.

Anchors are a stated query set that meets all rows in blocks. Both are written as packed integers
before they are shuffled, blocks are dealt by a row's place in the written table and not by its
label or id, and what leaves a block is bounded by anchors, slots and k.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from larder.sources.staging import stage

BLOCK_ROWS = 16384
BLOCK_ANCHORS = 8192
#: Anchors whose scores are held at a time.
_TILE = 128
#: Up to here sums of products of whole doubles are exact.
_EXACT = 2**53
_LONG = 2**63 - 1


def prepare(
    vectors: DataFrame, label: Column, id_column: str = "vec_id", vector_column: str = "embedding", scale: int = 256
) -> DataFrame:
    """(id, label, dim, x): rows that take part, with ``floor(scale * c)`` for each component c."""
    v = F.col(vector_column)
    usable = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return vectors.select(
        F.col(id_column).cast("long").alias("id"), label.cast("long").alias("label"), v.alias("v")
    ).where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & usable).select(
        "id",
        "label",
        F.size("v").alias("dim"),
        F.transform("v", lambda c: F.floor(c.cast("double") * F.lit(float(scale)))).alias("x"),
    )


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer inner products, anchors by rows; those beyond a long become the nearest long."""
    if not rows.shape[1]:
        return np.zeros((len(anchors), len(rows)), dtype=np.int64)
    most = float(np.abs(anchors.astype(np.float64)).max()) * float(np.abs(rows.astype(np.float64)).max())
    if most * rows.shape[1] < _EXACT:
        return (anchors.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    wide = anchors.astype(object) @ rows.astype(object).T
    return np.array([[min(max(s, -_LONG), _LONG) for s in line] for line in wide], dtype=np.int64).reshape(wide.shape)


def best(line: np.ndarray, places: np.ndarray, k: int) -> np.ndarray:
    """Those of ``places`` with the k largest values of ``line``, in falling order; equal ones in the given order."""
    values = line[places]
    if len(places) > k:
        floor = np.partition(values, len(values) - k)[len(values) - k]
        keep = values >= floor
        places, values = places[keep], values[keep]
    return places[np.argsort(-values, kind="stable")[:k]]


def _matrix(column: pd.Series, dim: int) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.int64).reshape(len(column), dim) if len(column) else np.zeros((0, dim), np.int64)


class _Block:
    """A block of rows in order of label, then id, so that a label is a slice."""

    def __init__(self, rows: pd.DataFrame):
        order = np.lexsort((rows["id"].to_numpy(), rows["label"].to_numpy()))
        self.ids = rows["id"].to_numpy()[order]
        self.labels = rows["label"].to_numpy()[order]
        self.x = _matrix(rows["x"], int(rows["dim"].iat[0]))[order]

    def of(self, label: int) -> slice:
        first, last = (int(np.searchsorted(self.labels, label, side=x)) for x in ("left", "right"))
        return slice(first, last)

    def lines(self, anchors: pd.DataFrame):
        """(anchor row, its scores) for each anchor."""
        x = _matrix(anchors["x"], self.x.shape[1])
        for low in range(0, len(anchors), _TILE):
            tile = scores(x[low : low + _TILE], self.x)
            for i, line in enumerate(tile):
                yield low + i, line


def _positives(rows: pd.DataFrame, anchors: pd.DataFrame, n: int):
    """(anchor, row, score) of a block: the n best other rows of each anchor's label."""
    block = _Block(rows)
    labels, ids = anchors["label"].tolist(), anchors["id"].tolist()
    for a, line in block.lines(anchors):
        mine = block.of(labels[a])
        places = np.arange(mine.start, mine.stop)
        places = places[block.ids[places] != ids[a]]
        for place in best(line, places, n).tolist():
            yield ids[a], int(block.ids[place]), int(line[place])


def _slots(rows: pd.DataFrame, anchors: pd.DataFrame, k: int):
    """(anchor, slot, row, score) of a block: the k best rows of other labels in each slot.

    Slot s holds the scores up to the s-th limit of the anchor (limits fall) and above the next one.
    """
    block = _Block(rows)
    by_id = np.argsort(block.ids, kind="stable")  # equal scores of one slot go by id across labels
    labels, ids, limits, floors = (anchors[c].tolist() for c in ("label", "id", "limits", "lowest"))
    for a, line in block.lines(anchors):
        inside = (line <= limits[a][0]) & (line >= floors[a])
        inside[block.of(labels[a])] = False
        places = by_id[inside[by_id]]
        values = line[places]
        ends = [*list(limits[a])[1:], None]
        for slot, (top, below) in enumerate(zip(list(limits[a]), ends)):
            here = places[(values <= top) if below is None else (values <= top) & (values > below)]
            for place in best(line, here, k).tolist():
                yield ids[a], slot, int(block.ids[place]), int(line[place])


def _meet(rows: DataFrame, anchors: DataFrame, blocks: int, chunks: int, search, schema: str) -> DataFrame:
    """Each block of rows with each chunk of the anchors of the same length."""

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    names = [part.split()[0] for part in schema.split(", ")]

    def both(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = search(left, right) if len(left) and len(right) else ()
        return pd.DataFrame(list(found), columns=names).astype("int64")

    keys = ("dim", "block", "chunk")
    return (
        rows.withColumn("chunk", every(chunks))
        .groupBy(*keys)
        .cogroup(anchors.withColumn("block", every(blocks)).groupBy(*keys))
        .applyInPandas(both, schema)
    )


def windows(positives: DataFrame, low: int, high: int) -> DataFrame:
    """(anchor_id, positive_id, positive_score, from, to): whole scores s with low * p <= 100 * s <= high * p."""
    p = F.col("positive_score")
    wide = p.cast("decimal(38,0)")
    return positives.withColumns(
        {"from": F.ceil(wide * low / F.lit(100)).cast("long"), "to": F.floor(wide * high / F.lit(100)).cast("long")}
    ).where("from <= to")


def mine(
    vectors: DataFrame,
    label: Column,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``label`` and ``is_anchor`` are expressions over ``vectors``. Rows with a null id or label, a
    null vector, or a null or non-finite component take no part; an empty vector has only scores of
    0. Vectors meet those of their own length. Rows under the anchor's own id are the anchor
    itself; anchors of one id are searched once, by the smallest vector. Rows repeated under another
    id are rows each. Ties go to the smaller id. A positive with a negative score has an empty
    window. An anchor without positives or without rows in a window, and an empty table, give no
    row. Other columns of ``vectors``, whatever their names, are not looked at.
    """
    rows = prepare(vectors, label, id_column, vector_column)
    rows = stage(rows.withColumn("place", F.monotonically_increasing_id()), "mined-rows")
    asked = prepare(vectors.where(is_anchor), label, id_column, vector_column).groupBy("id", "dim")
    asked = stage(asked.agg(F.min(F.struct("x", "label")).alias("a")).select("id", "dim", "a.*"), "anchors")
    counts = [t.agg(F.count(F.lit(1))).first()[0] for t in (rows, asked)]
    blocks, chunks = (max(1, math.ceil(n / m)) for n, m in zip(counts, (BLOCK_ROWS, BLOCK_ANCHORS)))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("place"), F.lit(blocks)).cast("int")).drop("place")
    asked = asked.withColumn("chunk", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(chunks)).cast("int"))

    near = _meet(
        rows, asked, blocks, chunks, lambda x, y: _positives(x, y, positives),
        "anchor_id long, positive_id long, positive_score long",
    )
    order = W.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    first = near.withColumn("n", F.row_number().over(order)).where(F.col("n") <= positives)
    wanted = stage(windows(first, low, high), "windows")

    # At most ``positives`` limits an anchor.
    limits = wanted.groupBy("anchor_id").agg(
        F.sort_array(F.collect_set("to"), False).alias("limits"), F.min("from").alias("lowest")
    )
    sought = asked.join(limits, asked["id"] == limits["anchor_id"]).drop("anchor_id")
    in_slots = _meet(
        rows, sought, blocks, chunks, lambda x, y: _slots(x, y, negatives),
        "anchor_id long, slot long, negative_id long, negative_score long",
    )
    slot_order = W.partitionBy("anchor_id", "slot").orderBy(F.desc("negative_score"), "negative_id")
    kept = in_slots.withColumn("n", F.row_number().over(slot_order)).where(F.col("n") <= negatives)

    # Slots in falling order: a window's suffix begins at its own limit and ends at its lower one.
    falling = kept.groupBy("anchor_id").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("negative_score")).alias("minus"), "negative_id"))).alias("kept")
    )
    suffix = F.filter("kept", lambda e: (-e["minus"] <= F.col("to")) & (-e["minus"] >= F.col("from")))
    return (
        wanted.join(falling, "anchor_id")
        .select("anchor_id", "positive_id", "positive_score", F.posexplode(F.slice(suffix, 1, negatives)).alias("i", "e"))
        .select(
            "anchor_id",
            "positive_id",
            (F.col("i") + 1).alias("rank"),
            F.col("e.negative_id").alias("negative_id"),
            "positive_score",
            (-F.col("e.minus")).alias("negative_score"),
        )
    )


#: The labels and windows of the registered query, and brute force over all pairs of anchor and row.
OP11_SQL = """
WITH used AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
   list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
   AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
   CAST(list_dot_product(CAST(a.x AS DOUBLE[]), CAST(b.x AS DOUBLE[])) AS BIGINT) AS score
  FROM used a JOIN used b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, n.id AS negative_id, p.positive_score,
 n.score AS negative_score
FROM positives p JOIN pairs n ON p.anchor_id = n.anchor_id AND NOT n.same
 AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.id)
QUALIFY row_number() OVER w <= 10"""


def op11_query(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors, shifted, F.col("vec_id") % 100 == 0)
