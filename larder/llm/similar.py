"""Groups of similar documents: wide SimHash prints, BK-trees per routing key, components.

A print of 512 bits estimates the similarity of two texts' sets of five-word shingles: at a
similarity of s a bit differs with chance acos(2s / (1 + s)) / pi, so 0.8 is met at some 78 bits.
Pairs to compare agree on one of ``ROUTES`` keys, each of ``ROUTE_ROWS`` MinHash values of the same
shingles. Distinct prints of a key form BK-trees; the trees of a key above ``TREE_NODES`` prints are
handed to every slice of its probes, so no task holds more than two such parts and no link inside a
key is lost.

A key is shared with chance s^4, at least one of 24 with chance 0.96 at a similarity of 0.6, above
0.998 from 0.7 and above 0.9999 from 0.8 on. Unrelated texts share no shingle and so no key, however
many there are: what is compared follows from the copies. Prints whose texts are not at hand are
routed by ``BANDS`` fixed choices of ``BAND_BITS`` bits; there unrelated prints meet, by the square
of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from larder.llm.batches import bound_batches
from larder.llm.bktree import BKTree, TREE_NODES, components
from larder.sources.staging import stage

SHINGLE = 5
BITS = 512
#: Differing bits of linked prints: similarity 0.8, and one and a half standard deviations of its estimate.
RADIUS = 90
ROUTES, ROUTE_ROWS = 24, 4
BANDS, BAND_BITS = 96, 20
_ROWS = 255
_CHUNK = _ROWS * 64
_ROUTE_CHUNK = 1024


def _mixed(x: np.ndarray) -> np.ndarray:
    """A fixed pseudo-random permutation of 64-bit values."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Distinct 64-bit hashes of a text's word shingles; none without a word.

    A-Z are lowered, words are split at ASCII white space; a text with fewer words than a shingle is
    one shingle.
    """
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    known = {w: digest(w, 0) for w in set(words)}
    hashes = np.fromiter((known[w] for w in words), np.uint64, len(words))
    n = max(len(words) - shingle + 1, 1)
    total = np.zeros(n, np.uint64)
    for i in range(min(shingle, len(words))):
        total = _mixed(total + hashes[i : i + n] + np.uint64(1))
    return np.unique(total)


def wide_print(text: str | None, shingle: int = SHINGLE) -> bytes:
    """``BITS`` bits, each set when more than half of the distinct shingles' values have it."""
    return _print(shingle_hashes(text, shingle))


def _print(hashes: np.ndarray) -> bytes:
    if not len(hashes):
        return bytes(BITS // 8)
    lanes = np.arange(1, BITS // 64 + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), _CHUNK):
        part = hashes[at : at + _CHUNK]
        rows = np.zeros((-(-len(part) // _ROWS) * _ROWS, BITS // 64), "<u8")
        rows[: len(part)] = _mixed(part[:, None] + lanes)
        bits = np.unpackbits(rows.view(np.uint8), axis=1, bitorder="little")
        # At most 255 rows are summed in a byte.
        counts += bits.reshape(-1, _ROWS, BITS).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return np.packbits((2 * counts > len(hashes)).astype(np.uint8), bitorder="little").tobytes()


#: Odd factors; each orders the hashes in a way of its own.
_FACTORS = _mixed(np.arange(1, ROUTES * ROUTE_ROWS + 1, dtype=np.uint64)) | np.uint64(1)


def route_keys(hashes: np.ndarray) -> np.ndarray:
    """``ROUTES`` longs, each of the least of the hashes in ``ROUTE_ROWS`` orders; none without a hash."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    least = np.full(len(_FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), _ROUTE_CHUNK):
        least = np.minimum(least, (hashes[at : at + _ROUTE_CHUNK, None] * _FACTORS).min(axis=0))
    keys = np.arange(1, ROUTES + 1, dtype=np.uint64)
    for values in least.reshape(ROUTES, ROUTE_ROWS).T:
        keys = _mixed(keys + values)
    return keys.view(np.int64)


def mark_column(text: Column, shingle: int = SHINGLE) -> Column:
    """The print of a text and its routing keys, both from one pass over its shingles."""

    @F.pandas_udf("print binary, keys array<long>")
    def of(texts: pd.Series) -> pd.DataFrame:
        prints, keys = [], []
        for x in texts:
            hashes = shingle_hashes(x, shingle)
            prints.append(_print(hashes))
            keys.append(route_keys(hashes))
        return pd.DataFrame({"print": pd.Series(prints, dtype=object), "keys": pd.Series(keys, dtype=object)})

    return of(text)


def _band_choices() -> np.ndarray:
    draw = np.random.default_rng(20)
    return np.stack([draw.permutation(BITS)[:BAND_BITS] for _ in range(BANDS)])


def band_keys(prints: Column) -> Column:
    """Array of one long for each band: its number and the value of its bits."""
    choices, powers = _band_choices(), 1 << np.arange(BAND_BITS, dtype=np.int64)
    numbers = np.arange(BANDS, dtype=np.int64) << BAND_BITS

    @F.pandas_udf("array<long>")
    def of(values: pd.Series) -> pd.Series:
        out: list[np.ndarray] = []
        for at in range(0, len(values), 1024):
            raw = np.frombuffer(b"".join(values[at : at + 1024]), np.uint8).reshape(-1, BITS // 8)
            bits = np.unpackbits(raw, axis=1, bitorder="little")
            out += list(bits[:, choices].astype(np.int64) @ powers + numbers)
        return pd.Series(out, dtype=object)

    return of(prints)


def _forest(tree_values: list[int], probes: list[int], radius: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links between probes and tree.

    A probe that is linked to a tree all of one component needs no further link.
    """
    parent = {v: v for v in tree_values}

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    tree, loose, edges = BKTree(tree_values), len(parent), []
    for probe in probes:
        linked = probe in parent
        parent.setdefault(probe, probe)
        if linked and loose == 1:
            continue
        for found in tree.within(probe, radius):
            a, b = find(probe), find(found)
            if a != b:
                parent[max(a, b)] = min(a, b)
                edges.append((probe, found))
                loose -= linked
                linked = True
                if loose == 1:
                    break
    return edges


def similar_links(prints: DataFrame, radius: int = RADIUS, tree_nodes: int = TREE_NODES) -> DataFrame:
    """Rows (u, v) whose components are those of all links inside routing keys.

    ``prints`` has a non-null binary column ``print`` and is a written table of distinct rows. Its column
    ``keys`` holds routing keys; texts of other keys may have the same print, which then is compared
    under all of them. Without that column the keys are those of the bit bands.
    """
    keys = F.col("keys") if "keys" in prints.columns else band_keys(F.col("print"))
    keyed = prints.select("print", F.explode(keys).alias("key"))
    # Written, so that Catalyst knows how few keys are shared before prints move.
    crowded = stage(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared-keys")
    parts = F.ceil(F.col("n") / F.lit(tree_nodes)).cast("int")
    members = keyed.join(crowded, "key").select(
        "key", "print", parts.alias("parts"), F.pmod(F.xxhash64("print"), parts).cast("int").alias("own")
    )
    cells = members.select(
        "key", "print", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    ).select(
        "key",
        F.least("own", "other").alias("tree"),
        F.greatest("own", "other").alias("slice"),
        "print",
        (F.col("own") <= F.col("other")).alias("in_tree"),
        (F.col("own") >= F.col("other")).alias("in_probes"),
    )
    width = BITS // 8

    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, nodes, probes = None, [], []
        out: list[tuple[bytes, bytes]] = []

        def add() -> None:
            for a, b in _forest(nodes, probes, radius):
                out.append((a.to_bytes(width, "little"), b.to_bytes(width, "little")))

        for batch in batches:
            for key, tree, part, value, in_tree, in_probes in zip(*(batch[c].tolist() for c in batch)):
                if (key, tree, part) != at:
                    add()
                    at, nodes, probes = (key, tree, part), [], []
                number = int.from_bytes(value, "little")
                if in_tree:
                    nodes.append(number)
                if in_probes:
                    probes.append(number)
            if len(out) >= 20_000:
                yield pd.DataFrame(out, columns=["u", "v"])
                out.clear()
        add()
        yield pd.DataFrame(out, columns=["u", "v"], dtype=object)

    return (
        cells.repartition("key", "tree", "slice")
        .sortWithinPartitions("key", "tree", "slice")
        .mapInPandas(links, "u binary, v binary")
        .distinct()
    )


def deduplicate(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of every group of linked documents: that of the smallest doc_id, null ids last.

    Texts of equal shingles are one print. A null or wordless text has the print without a bit. Of rows
    that share the smallest id one stays. Columns and their order are those of ``docs``, whatever
    their names; an empty table gives an empty result.
    """
    bound_batches(docs.sparkSession)
    names = docs.columns
    marked = stage(
        docs.select(
            F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc"),
            mark_column(F.col("text"), shingle).alias("mark"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "printed",
    )
    rows = marked.select("mark.print", "row", F.col("doc.doc_id").alias("id"))
    prints = stage(marked.select("mark.print", "mark.keys").distinct(), "prints")
    roots = stage(components(similar_links(prints, radius)), "similar-roots")
    rooted = rows.join(roots, F.col("print") == F.col("node"), "left").select(
        F.coalesce("root", "print").alias("root"), F.struct(F.col("id").isNull().alias("none"), "id", "row").alias("at")
    )
    kept = rooted.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    groups = stage(kept.where("n > 1").select("root", F.col("first.row").alias("stays")), "groups-of-similar")
    # Only what goes is joined with the texts, and only ids of shared groups are.
    gone = stage(rooted.join(groups, "root").where("at.row <> stays").select(F.col("at.row").alias("row")), "similar-rows")
    return marked.join(gone, "row", "left_anti").select(*[F.col("doc")[c].alias(c) for c in names])
