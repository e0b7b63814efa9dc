"""Nearest neighbours by inner product over randomly rotated one-bit codes.

A vector is divided by its norm, padded to ``bits`` dimensions and turned by a random rotation;
of each turned coordinate only the sign is kept. From the packed bits, the norm and the inner
product of a vector with its own code (the correction scalar) follows an unbiased estimate of any
inner product, with an error bound that holds for a vector with a chance set by ``SPREAD``
(Gao and Long, 2024).

The stated queries meet all rows in blocks: a block of codes and vectors with a block of queries.
In a block, a query's best estimates are computed exactly first; then every vector whose upper
bound reaches the k-th best of these is computed exactly too, so only vectors that the bounds rule
out are passed over. Blocks are cut by a hash of the id: their size does not depend on the data.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from larder.sources.staging import stage

SEED = 6
#: Code bits for each dimension; more bits narrow the bounds by their square root.
BITS_PER_DIM = 4
#: Bound in standard deviations of the estimate.
SPREAD = 4.0
BLOCK_ROWS = 8192
BLOCK_QUERIES = 4096
_CODE_CHUNK = 1024


def rotation(dim: int, bits: int, seed: int = SEED) -> np.ndarray:
    """The first ``dim`` rows of a random rotation of ``bits`` dimensions; padding needs no others."""
    rng = np.random.default_rng([seed, dim, bits])
    q, r = np.linalg.qr(rng.standard_normal((bits, dim)))
    return (q * np.sign(np.diag(r))).T


def code_bits(dim: int) -> int:
    return 8 * math.ceil(dim * BITS_PER_DIM / 8)


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, norms, and inner products of unit vectors with their codes."""
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    turned = (vectors / norms[:, None]) @ turn
    bits = turned > 0
    own = np.abs(turned).sum(axis=1) / math.sqrt(turn.shape[1])
    return np.packbits(bits, axis=1), norms, own


def estimate(packed: np.ndarray, own: np.ndarray, queries: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosines (queries by rows) and each row's error bound, from codes alone."""
    size = turn.shape[1]
    signs = np.unpackbits(packed, axis=1, count=size).astype(np.float32) * 2 - 1
    turned = (queries / np.sqrt((queries * queries).sum(axis=1))[:, None]) @ turn
    guess = (turned.astype(np.float32) @ signs.T) / math.sqrt(size) / own.astype(np.float32)
    error = SPREAD * np.sqrt(np.maximum(0.0, 1 - own**2)) / own / math.sqrt(max(1, size - 1))
    return guess, error.astype(np.float32) + 1e-5


def _usable(v: Column) -> Column:
    """Finite, non-empty, not all zero, no null."""
    return (
        v.isNotNull()
        & (F.size(v) > 0)
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & F.exists(v, lambda x: x != 0)
    )


def prepare(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(id, dim, v): rows that take part, as doubles."""
    v = F.col(vector_column)
    return vectors.select(F.col(id_column).cast("long").alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & _usable(F.col("v"))
    ).select("id", F.size("v").alias("dim"), F.col("v").cast("array<double>").alias("v"))


def build_index(prepared: DataFrame, seed: int = SEED) -> DataFrame:
    """(id, dim, v, code, norm, own): every row with its code; the rotation follows from the seed."""

    def coded(batches):
        for batch in batches:
            for dim, part in batch.groupby("dim", sort=False):
                packed, norms, own = encode(np.stack(part["v"].to_numpy()), rotation(dim, code_bits(dim), seed))
                yield part.assign(code=[x.tobytes() for x in packed], norm=norms, own=own)

    return prepared.mapInPandas(coded, "id long, dim int, v array<double>, code binary, norm double, own double")


def _exact(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision, each summed in the same order."""
    return (vectors * query).sum(axis=1)


def nearest_in_block(ids: np.ndarray, vectors: np.ndarray, packed: np.ndarray, norms: np.ndarray, own: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, turn: np.ndarray, k: int):
    """(query id, id, score) of the k best of a block for each query, ties to the smaller id."""
    out = []
    order = np.argsort(ids, kind="stable")
    ids, vectors, packed, norms, own = ids[order], vectors[order], packed[order], norms[order], own[order]
    for low in range(0, len(query_ids), _CODE_CHUNK):
        part = queries[low : low + _CODE_CHUNK]
        guess, error = estimate(packed, own, part, turn)
        for row, (query_id, query) in enumerate(zip(query_ids[low : low + _CODE_CHUNK].tolist(), part)):
            length = math.sqrt(float((query * query).sum()))
            about = guess[row] * norms * length
            upper = about + error * norms * length
            other = ids != query_id
            about = np.where(other, about, -np.inf)
            first = min(4 * k, len(ids))
            tried = np.argpartition(-about, first - 1)[:first]
            tried = tried[other[tried]]
            scores = _exact(vectors[tried], query)
            if len(tried) >= k:
                floor = np.partition(scores, len(scores) - k)[len(scores) - k]
                wanted = other & (upper >= floor)
                wanted[tried] = False
                more = np.flatnonzero(wanted)
            else:
                rest = other.copy()
                rest[tried] = False
                more = np.flatnonzero(rest)
            if len(more):
                tried = np.concatenate([tried, more])
                scores = np.concatenate([scores, _exact(vectors[more], query)])
            best = np.lexsort((ids[tried], -scores))[:k]
            out += [(query_id, int(ids[tried[i]]), float(scores[i])) for i in best]
    return out


def search(vectors: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding", seed: int = SEED) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row with ``is_query`` its k nearest other rows.

    Rows under the query's own id are its own; queries of one id are searched once, by the
    smallest vector. Rows repeated under another id are ranked each. Vectors meet vectors of their
    own length only. With fewer than k candidates all are returned; an empty table gives no row.
    """
    prepared = prepare(vectors, id_column, vector_column)
    index = stage(build_index(prepared, seed), "one-bit-index")
    queries = stage(
        prepare(vectors.where(is_query), id_column, vector_column).groupBy("id", "dim").agg(F.min("v").alias("v")),
        "queries",
    )
    sizes = [x.agg(F.count(F.lit(1))).first()[0] for x in (index, queries)]
    blocks, chunks = (max(1, math.ceil(n / m)) for n, m in zip(sizes, (BLOCK_ROWS, BLOCK_QUERIES)))

    def spread(n: int, salt: int) -> Column:
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    rows = index.withColumn("block", spread(blocks, 1)).withColumn("chunk", every(chunks))
    asked = queries.withColumn("chunk", spread(chunks, 2)).withColumn("block", every(blocks))

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            dim = int(left["dim"].iat[0])
            bits = code_bits(dim)
            found = nearest_in_block(
                left["id"].to_numpy(),
                np.stack(left["v"].to_numpy()),
                np.frombuffer(b"".join(left["code"]), np.uint8).reshape(len(left), bits // 8),
                left["norm"].to_numpy(),
                left["own"].to_numpy(),
                right["id"].to_numpy(),
                np.stack(right["v"].to_numpy()),
                rotation(dim, bits, seed),
                k,
            )
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"}
        )

    keys = ("dim", "block", "chunk")
    near = (
        rows.groupBy(*keys)
        .cogroup(asked.groupBy(*keys))
        .applyInPandas(meet, "query_id long, vec_id long, score double")
    )
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def op6_query(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return search(vectors, F.col("vec_id") % 20 == 0)
