"""Many K-Means fits over the same rows in shared passes.

An elbow with several starts for each k is dozens of fits, each of which would read the rows once an
iteration. Here one pass moves all of them: a task measures its rows against the centres of every
fit that still moves, and what is exchanged is one line of sums for each centre. Fits whose centres
rest drop out, so the passes are those of the slowest fit. All starts take their first centres from
one bounded hash sample: k-means++ and Lloyd's iterations on the sample alone (Bradley and Fayyad,
1998), so the passes over the rows begin near their end.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

#: Centres rest when the sum of their squared moves is at most this share of the mean column variance.
MAX_ITERATIONS, TOLERANCE = 300, 1e-4
#: Rows from which first centres are drawn.
SEED_ROWS = 4096
_STEP = 4096


@dataclass
class Fit:
    k: int
    seed: int
    centers: np.ndarray
    cost: float = float("inf")
    passes: int = 0


def complete_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns as doubles, without rows that lack one."""
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    usable = [F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")) for c in columns]
    return rows.where(F.forall(F.array(*usable), lambda ok: ok))


def seed_rows(rows: DataFrame, columns: list[str]) -> np.ndarray:
    """The distinct rows of smallest hash, at most ``SEED_ROWS``."""
    chosen = rows.distinct().orderBy(F.xxhash64(*columns), *columns).limit(SEED_ROWS).collect()
    return np.array([tuple(r) for r in chosen], dtype=np.float64).reshape(len(chosen), len(columns))


def plus_plus(points: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k-means++ centres among the points; fewer where there are fewer distinct points."""
    rng = np.random.default_rng([seed, k])
    centers = [points[rng.integers(len(points))]]
    near = ((points - centers[0]) ** 2).sum(axis=1)
    while len(centers) < k and near.sum() > 0:
        centers.append(points[rng.choice(len(points), p=near / near.sum())])
        near = np.minimum(near, ((points - centers[-1]) ** 2).sum(axis=1))
    return np.array(centers)


def refined(points: np.ndarray, centers: np.ndarray, limit: float) -> np.ndarray:
    """Lloyd's iterations over the sample."""
    for _ in range(MAX_ITERATIONS):
        own = ((centers**2).sum(axis=1) - 2 * points @ centers.T).argmin(axis=1)
        n = np.bincount(own, minlength=len(centers))[:, None]
        sums = np.stack([np.bincount(own, c, len(centers)) for c in points.T], axis=1)
        moved = np.where(n > 0, sums / np.maximum(n, 1), centers)
        before, centers = centers, moved
        if ((centers - before) ** 2).sum() <= limit:
            break
    return centers


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])


def sums_by_center(rows: DataFrame, columns: list[str], groups: list[np.ndarray]) -> np.ndarray:
    """For each centre of each group: number, cost, and column sums of the rows it is nearest to.

    One pass over ``rows``; of centres as near as each other the first counts.
    """
    centers = np.vstack(groups)
    starts = np.cumsum([0] + [len(g) for g in groups]).tolist()
    length = (centers**2).sum(axis=1)
    names = [f"s{i}" for i in range(len(columns))]
    schema = ", ".join(["center int", "n double", "cost double", *[f"{n} double" for n in names]])
    target = pa.schema([("center", pa.int32()), ("n", pa.float64()), ("cost", pa.float64()), *[(n, pa.float64()) for n in names]])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centers), len(columns) + 2))
        for batch in batches:
            whole = _matrix(batch)
            for low in range(0, len(whole), _STEP):
                x = whole[low : low + _STEP]
                gap = length - 2 * x @ centers.T  # less the row's own length, which does not change the order
                member = np.zeros_like(gap)
                for a, b in zip(starts, starts[1:]):
                    member[np.arange(len(x)), a + gap[:, a:b].argmin(axis=1)] = 1.0
                own = (x**2).sum(axis=1)[:, None]
                total[:, 0] += member.sum(axis=0)
                total[:, 1] += (member * np.maximum(gap + own, 0.0)).sum(axis=0)
                total[:, 2:] += member.T @ x
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(centers), dtype=np.int32)), *[pa.array(c) for c in total.T]], schema=target
        )

    lines = rows.mapInArrow(measure, schema).groupBy("center").agg(*[F.sum(n).alias(n) for n in ("n", "cost", *names)])
    out = np.zeros((len(centers), len(columns) + 2))
    for r in lines.collect():  # as many as there are centres
        out[r["center"]] = list(r)[1:]
    return out


def fit_all(df: DataFrame, columns: list[str], settings: list[tuple[int, int]]) -> list[Fit]:
    """Fits for (k, seed) pairs: Lloyd's iterations until the centres rest (``TOLERANCE``).

    Rows without a value in one of the columns take no part. A centre without rows stays where it
    is. The cost is that of the returned centres. Without rows there are no centres and no cost.
    """
    rows = complete_rows(df, columns).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        points = seed_rows(rows, columns)
        if not len(points):
            return [Fit(k, seed, np.zeros((0, len(columns))), 0.0) for k, seed in settings]
        variance = rows.agg(*[F.var_pop(c) for c in columns]).first()
        limit = TOLERANCE * float(np.mean([v or 0.0 for v in variance]))
        fits = [Fit(k, seed, refined(points, plus_plus(points, k, seed), limit)) for k, seed in settings]
        moving = list(fits)
        for _ in range(MAX_ITERATIONS):
            if not moving:
                break
            found = sums_by_center(rows, columns, [f.centers for f in moving])
            still, at = [], 0
            for f in moving:
                part = found[at : at + len(f.centers)]
                at += len(f.centers)
                n = part[:, :1]
                moved = np.where(n > 0, part[:, 2:] / np.maximum(n, 1.0), f.centers)
                far = ((moved - f.centers) ** 2).sum()
                f.centers, f.passes = moved, f.passes + 1
                if far > limit:
                    still.append(f)
            moving = still
        found, at = sums_by_center(rows, columns, [f.centers for f in fits]), 0
        for f in fits:
            f.cost = float(found[at : at + len(f.centers), 1].sum())
            at += len(f.centers)
        return fits
    finally:
        rows.unpersist()


def nearest(df: DataFrame, columns: list[str], centers: np.ndarray, cluster: str, distance: str) -> DataFrame:
    """Rows with their nearest centre and the distance to it; null for rows that lack a value."""
    if not len(centers):
        return df.withColumns({cluster: F.lit(None).cast("int"), distance: F.lit(None).cast("double")})
    options = []
    for i, center in enumerate(centers.tolist()):
        total = F.lit(0.0)
        for c, at in zip(columns, center):
            gap = F.col(c).cast("double") - F.lit(at)
            total = total + gap * gap
        options.append(F.struct(total.alias("d"), F.lit(i).alias("i")))
    best = F.array_min(F.array(*options))
    whole = F.forall(F.array(*[F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in columns]), lambda ok: ok)
    found = df.withColumn("_best", F.when(whole, best))
    return found.withColumns({cluster: F.col("_best.i"), distance: F.sqrt("_best.d")}).drop("_best")


def silhouette(
    df: DataFrame, columns: list[str], cluster: str, sample: int, name: str = "silhouette_euclidean"
) -> DataFrame:
    """Mean Euclidean silhouette of given labels, over the ``sample`` rows of smallest hash.

    Exact where the table is not larger than the sample. The sample's rows are measured against the
    sample in blocks; a row in a cluster of its own scores 0, a table with one cluster null. Rows
    without a label or a value take no part.
    """
    spark = df.sparkSession
    labelled = df.where(F.col(cluster).isNotNull()).select(F.col(cluster).cast("string").alias("_cluster"), *columns)
    usable = [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in columns]
    rows = labelled.where(F.forall(F.array(*usable), lambda ok: ok)).select(
        "_cluster", *[F.col(c).cast("double").alias(c) for c in columns]
    )
    chosen = rows.orderBy(F.xxhash64("_cluster", *columns), "_cluster", *columns).limit(sample).persist(StorageLevel.MEMORY_AND_DISK)
    anchors = chosen.orderBy("_cluster").toPandas()  # at most ``sample`` rows
    labels, first, sizes = np.unique(anchors["_cluster"].to_numpy(dtype=str), return_index=True, return_counts=True)
    if len(labels) < 2:
        chosen.unpersist()
        return spark.createDataFrame([(None,)], f"{name} double")
    points = anchors[columns].to_numpy(dtype=np.float64)
    step = max(1, 8_000_000 // len(points))
    kept = spark.sparkContext.broadcast((points, labels, first, sizes))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points, labels, first, sizes = kept.value
        for batch in batches:
            own = np.searchsorted(labels, np.array(batch.column(0).to_pylist(), dtype=str))
            whole = _matrix(batch.select(columns))
            for low in range(0, len(whole), step):
                x, mine = whole[low : low + step], own[low : low + step]
                gap = sum((x[:, i : i + 1] - points[:, i]) ** 2 for i in range(len(columns)))
                sums = np.add.reduceat(np.sqrt(gap), first, axis=1)
                at = np.arange(len(x))
                inside = sums[at, mine] / np.maximum(sizes[mine] - 1, 1)
                means = sums / sizes
                means[at, mine] = np.inf
                outside = means.min(axis=1)
                most = np.maximum(inside, outside)
                score = np.where((sizes[mine] == 1) | (most == 0), 0.0, (outside - inside) / np.where(most == 0, 1.0, most))
                yield pa.RecordBatch.from_arrays([pa.array(score)], ["score"])

    # The sample comes out of one task; it is spread, since its cost is its square.
    spread = chosen.repartition(max(1, spark.sparkContext.defaultParallelism))
    return spread.mapInArrow(measure, "score double").agg(F.avg("score").alias(name))
