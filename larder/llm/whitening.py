"""Whitening components of vectors by shifted Cholesky QR.

The centred rows are a tall matrix that no task holds. A pass over it sums the small Gram matrix of
the rows (as orthogonalised so far), whose Cholesky factor turns the rows by one more triangular
solve. The first Gram matrix is shifted, so its factor exists however close to singular the rows
are; two further passes bring the rows to full orthogonality (Fukaya, Kannan, Nakatsukasa, Yamamoto
and Yanagisawa, 2020). The product of the factors is the R of the rows' QR, and its singular values
and right vectors are theirs: forming the covariance itself would square their condition.

Rows stay in Spark. What is summed across tasks is a matrix of one vector length by itself, combined
row by row in an exchange; the driver holds matrices of that size only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from larder.sources.staging import stage

MAX_PASSES = 6
#: Rows are orthogonal when their Gram matrix is a projection up to this.
ORTHOGONAL = 1e-10
#: Components whose spread is this much below the first one's are rounding noise and have no scale.
FLAT = 1e-7
_UNIT = np.finfo(np.float64).eps / 2
_LONG = 2**63 - 1
_STEP = 4096


@dataclass
class Fit:
    """What the passes know of the vectors of one length."""

    n: int
    total: list[int]
    factors: list[np.ndarray] = field(default_factory=list)
    trace: float = 0.0
    done: bool = False
    #: Unit components as columns, and the deviation along each, in falling order.
    components: np.ndarray | None = None
    deviations: np.ndarray | None = None
    identity_error: float = 0.0


def prepare(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", scale: int = 256) -> DataFrame:
    """(id, dim, x): rows without null or non-finite entries, as ``floor(scale * c)``."""
    v = F.col(vector_column)
    usable = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return vectors.where(v.isNotNull() & usable).select(
        F.col(id_column).cast("long").alias("id"),
        F.size(v).alias("dim"),
        F.transform(v, lambda c: F.floor(c.cast("double") * F.lit(float(scale)))).alias("x"),
    )


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places in the batch, whole vectors), a bounded number of rows at a time."""
    dims = batch.column("dim").to_numpy()
    x = batch.column("x")
    flat, starts = x.values.to_numpy(), x.offsets.to_numpy()[:-1]
    for dim in np.unique(dims).tolist():
        places = np.flatnonzero(dims == dim)
        for low in range(0, len(places), _STEP):
            part = places[low : low + _STEP]
            yield dim, part, flat[starts[part][:, None] + np.arange(dim)]


def centred(x: np.ndarray, fit: Fit) -> np.ndarray:
    """x minus the mean, from whole numbers where they fit."""
    total = np.array(fit.total, dtype=object)
    if x.size and max(abs(int(x.min())), abs(int(x.max()))) * fit.n + max(map(abs, fit.total)) < _LONG:
        return (fit.n * x - total.astype(np.int64)) / fit.n
    return x.astype(np.float64) - np.array([t / fit.n for t in fit.total])


def deviation(x: np.ndarray, fit: Fit) -> list[int | None]:
    """Exact sum of ``(n * x - S)**2`` per row; None where it is beyond a long."""
    top = max([0, *map(abs, fit.total)]) + fit.n * (max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0)
    if top * top * max(1, x.shape[1]) <= _LONG:
        gap = fit.n * x - np.array(fit.total, dtype=np.int64)
        return (gap * gap).sum(axis=1).tolist()
    sums = ((fit.n * x.astype(object) - np.array(fit.total, dtype=object)) ** 2).sum(axis=1)
    return [s if s <= _LONG else None for s in sums.tolist()]


def solved(y: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Y R^-1 for an upper triangular R, column by column."""
    out = np.empty_like(y)
    for j in range(r.shape[0]):
        out[:, j] = (y[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


def _turned(x: np.ndarray, fit: Fit) -> np.ndarray:
    y = centred(x, fit)
    for r in fit.factors:
        y = solved(y, r)
    return y


def _whitened(x: np.ndarray, fit: Fit) -> np.ndarray:
    return centred(x, fit) @ fit.components / fit.deviations


def factor(gram: np.ndarray, rows: int, shifted: bool) -> np.ndarray:
    """Upper triangular R with R'R = gram, shifted by the least that makes it exist for sure."""
    d = len(gram)
    norm = float(np.linalg.norm(gram, 2)) or 1.0
    if not shifted:
        try:
            return np.linalg.cholesky(gram).T
        except np.linalg.LinAlgError:
            pass
    shift = min(1e-6, 11 * (min(rows, _STEP) * d + d * (d + 1)) * _UNIT) * norm
    return np.linalg.cholesky(gram + shift * np.eye(d)).T


def _summed(fit_list: DataFrame, part: Callable[[int, np.ndarray], np.ndarray | None]) -> dict[int, np.ndarray]:
    """The sum of ``part(length, vectors)`` over the fit list, for each length.

    Tasks sum their own rows; the lines of their matrices are then summed in an exchange by line.
    """
    schema = "dim int, line int, row array<double>"

    def flush(sums: dict[int, np.ndarray]) -> Iterator[pd.DataFrame]:
        for dim, matrix in sums.items():
            yield pd.DataFrame({"dim": dim, "line": range(len(matrix)), "row": list(matrix)})

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, _, x in _matrices(batch):
                found = part(dim, x)
                if found is not None:
                    sums[dim] = sums[dim] + found if dim in sums else found
        target = pa.schema([("dim", pa.int32()), ("line", pa.int32()), ("row", pa.list_(pa.float64()))])
        for frame in flush(sums):
            yield pa.RecordBatch.from_pandas(frame, schema=target, preserve_index=False)

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for dim, line, row in zip(batch["dim"], batch["line"], batch["row"]):
                key = (int(dim), int(line))
                sums[key] = sums[key] + row if key in sums else np.array(row)
        for (dim, line), row in sums.items():
            yield pd.DataFrame({"dim": [dim], "line": [line], "row": [row]})

    found = fit_list.mapInArrow(local, schema).repartition("dim", "line").mapInPandas(lines, schema).collect()
    out: dict[int, dict[int, list[float]]] = {}
    for r in found:
        out.setdefault(r["dim"], {})[r["line"]] = r["row"]
    return {dim: np.array([rows[i] for i in sorted(rows)]) for dim, rows in out.items()}


def _totals(fit_list: DataFrame) -> dict[int, Fit]:
    """Exact number and component sums of the vectors of each length."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            for dim, _, x in _matrices(batch):
                wide = x.size and max(abs(int(x.min())), abs(int(x.max()))) * len(x) >= _LONG
                total = (x.astype(object) if wide else x).sum(axis=0).astype(object)
                n, before = sums.get(dim, (0, 0))
                sums[dim] = (n + len(x), before + total)
        for dim, (n, total) in sums.items():
            lines = [-1, *range(dim)]  # line -1 holds the number of rows
            yield pa.RecordBatch.from_pydict(
                {"dim": pa.array([dim] * len(lines), pa.int32()), "line": pa.array(lines, pa.int32()), "total": [str(n), *map(str, total)]}
            )

    found = (
        fit_list.mapInArrow(local, "dim int, line int, total string")
        .groupBy("dim", "line")
        .agg(F.sum(F.col("total").cast("decimal(38,0)")).cast("string").alias("total"))
        .collect()
    )
    by_dim: dict[int, dict[int, int]] = {}
    for r in found:
        by_dim.setdefault(r["dim"], {})[r["line"]] = int(r["total"])
    return {dim: Fit(lines[-1], [lines[i] for i in range(dim)]) for dim, lines in by_dim.items()}


def fit_components(fit_list: DataFrame, components: int) -> dict[int, Fit]:
    """Components of the distinct vectors of each length; ``fit_list`` is read once a pass."""
    fits = {dim: f for dim, f in _totals(fit_list).items() if dim > 0}
    for turn in range(MAX_PASSES):
        open_ = {dim: f for dim, f in fits.items() if not f.done}
        if not open_:
            break
        grams = _summed(fit_list, lambda dim, x: (lambda y: y.T @ y)(_turned(x, open_[dim])) if dim in open_ else None)
        for dim, gram in grams.items():
            f = open_[dim]
            if not turn:
                f.trace = float(np.trace(gram)) / f.n
            f.done = f.trace == 0 or (turn > 1 and np.abs(gram @ gram - gram).max() <= ORTHOGONAL)
            if not f.done:
                f.factors.append(factor(gram, f.n, shifted=not turn))
    for dim, f in fits.items():
        r = np.eye(dim)
        for step in f.factors:
            r = step @ r
        _, spread, turned = np.linalg.svd(r)
        kept = [i for i in range(min(components, dim)) if f.trace > 0 and spread[i] > FLAT * spread[0]]
        f.components = turned[kept].T
        f.deviations = spread[kept] / np.sqrt(f.n)
    scaled = {dim: f for dim, f in fits.items() if f.components.shape[1]}
    means = _summed(fit_list, lambda dim, x: _whitened(x, scaled[dim]).sum(axis=0)[None, :] if dim in scaled else None)
    means = {dim: m / scaled[dim].n for dim, m in means.items()}
    grams = _summed(fit_list, lambda dim, x: (lambda y: y.T @ y)(_whitened(x, scaled[dim]) - means[dim]) if dim in scaled else None)
    for dim, gram in grams.items():
        f = scaled[dim]
        f.identity_error = float(np.abs(gram / f.n - np.eye(len(gram))).max())
    return fits


OUTPUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(
    vectors: DataFrame, components: int = 4, id_column: str = "vec_id", vector_column: str = "embedding", scale: int = 256
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for each usable row.

    The fit list holds each distinct whole vector once, so repeated rows do not weigh more; every
    row is returned, also repeated ones and those with a null id. Rows with a null vector or null or
    non-finite entries are dropped. Vectors of each length are fitted and whitened by themselves.
    Components in which the vectors do not differ have no scale and give no row; so do a single
    distinct vector, empty vectors and an empty table. Equal eigenvalues leave the choice of their
    vectors open, but it is one choice for all rows. ``deviation`` is null where it is beyond a
    long. Other columns of ``vectors``, whatever their names, are not looked at.
    """
    rows = stage(prepare(vectors, id_column, vector_column, scale), "whole-vectors")
    fit_list = stage(rows.select("dim", "x").dropDuplicates(), "fit-list")
    fits = fit_components(fit_list, components)
    for f in fits.values():
        f.factors = []  # not needed by the tasks below
    target = pa.schema(
        [("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
         ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())]
    )

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, places, x in _matrices(batch):
                f = fits.get(dim)
                k = f.components.shape[1] if f else 0
                if not k:
                    continue
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(pa.array(np.repeat(places, k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(x) * k, f.n)),
                        pa.array(deviation(x, f), pa.int64()).take(pa.array(np.repeat(np.arange(len(x)), k))),
                        pa.array(_whitened(x, f).ravel()),
                        pa.array(np.tile(f.deviations**2 / f.trace, len(x))),
                        pa.array(np.full(len(x) * k, f.identity_error)),
                    ],
                    schema=target,
                )

    return rows.mapInArrow(project, OUTPUT)


def op12_query(spark, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
