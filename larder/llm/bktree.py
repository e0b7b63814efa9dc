"""SimHash near-duplicates found with BK-trees.

Documents become 64-bit fingerprints. Two fingerprints within three bits agree on at least two
of five fixed blocks of bits, so the ten pairs of blocks give ten routing keys and every link
lies in a bucket of some key. Inside a bucket the fingerprints form a BK-tree (children keyed by
the integer Hamming distance to their parent), and a probe follows only edges whose distance lies
within the radius of its own. A bucket above ``TREE_NODES`` is cut into several trees and several
slices of probes; each tree is handed to every slice, so no task holds more than two such parts
whatever the skew, and no link is lost.

A task reports a spanning forest of the links it finds (at most one row per fingerprint), never
all pairs. Components of the whole follow from alternating star contraction over these rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from larder.llm.batches import bound_batches
from larder.sources.staging import stage

RADIUS = 3
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
TREE_NODES = 4096
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Signed 64-bit SimHash of a text's word shingles, repeats included; 0 without a word.

    A-Z are lowered, words are split at ASCII white space, and a bit is set when more than half
    of the shingles' XXH64 values have it. A text with fewer words than a shingle is one shingle.
    """
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        starts, ends = [0], [len(joined)]
    else:
        after = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        ends = (after[shingle - 1 :] - 1).tolist()
        starts = [0, *after[: len(words) - shingle].tolist()]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), _CHUNK):
        values = np.fromiter(
            (digest(joined[a:b], seed) for a, b in zip(starts[at : at + _CHUNK], ends[at : at + _CHUNK])),
            "<u8",
        )
        bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(starts)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprint_column(text: Column, shingle: int = 3, seed: int = 42) -> Column:
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(x, shingle, seed) for x in texts], dtype="int64")

    return of(text)


class BKTree:
    """Distinct 64-bit integers; ``within`` yields the stored values inside a radius."""

    def __init__(self, values=()):
        self.root: tuple[int, dict] | None = None
        for value in values:
            self.add(value)

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = (value, {})
            return
        held, children = self.root
        while d := (held ^ value).bit_count():
            child = children.get(d)
            if child is None:
                children[d] = (value, {})
                return
            held, children = child

    def within(self, value: int, radius: int) -> Iterator[int]:
        stack = [self.root] if self.root else []
        while stack:
            held, children = stack.pop()
            d = (held ^ value).bit_count()
            if d <= radius:
                yield held
            if children:
                if len(children) <= 2 * radius:
                    stack.extend(c for k, c in children.items() if d - radius <= k <= d + radius)
                else:
                    stack.extend(c for k in range(d - radius, d + radius + 1) if (c := children.get(k)))


def _forest(tree_values: list[int], probes: list[int], radius: int) -> list[tuple[int, int]]:
    """Star edges (member, smallest member) of the components that links within radius make."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while (up := parent.get(x, x)) != top:
            parent[x] = top
            x = up
        return top

    mask = (1 << 64) - 1
    tree = BKTree(v & mask for v in tree_values)
    for probe in probes:
        for found in tree.within(probe & mask, radius):
            a, b = find(probe & mask), find(found)
            if a != b:
                parent[max(a, b)] = min(a, b)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return [(signed(x), signed(find(x))) for x in list(parent)]


def _keys(fp: Column) -> Column:
    """The ten (key number, value of two blocks) pairs of a fingerprint."""

    def block(i: int) -> Column:
        low, width = BLOCKS[i]
        return F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1).cast("long"))

    return F.array(
        *[
            F.struct(
                F.lit(n).cast("tinyint").alias("k"),
                (F.shiftleft(block(a), 13) + block(b)).alias("v"),
            )
            for n, (a, b) in enumerate(combinations(range(len(BLOCKS)), 2))
        ]
    )


def spanning_links(fingerprints: DataFrame, tree_nodes: int = TREE_NODES) -> DataFrame:
    """Rows (u, v) whose components are those of all links within three bits.

    ``fingerprints`` has one distinct non-null long column ``fp``. u is never v. Buckets of one
    fingerprint are dropped by a count before any tree is built.
    """
    keyed = fingerprints.select("fp", F.explode(_keys(F.col("fp"))).alias("key")).select("fp", "key.k", "key.v")
    crowded = keyed.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / F.lit(tree_nodes)).cast("int")
    members = keyed.join(crowded, ["k", "v"]).select(
        "k", "v", "fp", parts.alias("parts"), F.pmod(F.xxhash64("fp"), parts).cast("int").alias("own")
    )
    cells = members.select(
        "k", "v", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    ).select(
        "k",
        "v",
        F.least("own", "other").alias("tree"),
        F.greatest("own", "other").alias("slice"),
        "fp",
        (F.col("own") <= F.col("other")).alias("in_tree"),
        (F.col("own") >= F.col("other")).alias("in_probes"),
    )

    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, nodes, probes = None, [], []
        out: list[tuple[int, int]] = []
        for batch in batches:
            for k, v, tree, part, fp, in_tree, in_probes in zip(*(batch[c].tolist() for c in batch)):
                cell = (k, v, tree, part)
                if cell != at:
                    if nodes and probes:
                        out += _forest(nodes, probes, RADIUS)
                    at, nodes, probes = cell, [], []
                if in_tree:
                    nodes.append(fp)
                if in_probes:
                    probes.append(fp)
            if len(out) >= 20_000:
                yield pd.DataFrame(out, columns=["u", "v"])
                out = []
        if nodes and probes:
            out += _forest(nodes, probes, RADIUS)
        yield pd.DataFrame(out, columns=["u", "v"], dtype="int64")

    return (
        cells.repartition("k", "v", "tree", "slice")
        .sortWithinPartitions("k", "v", "tree", "slice")
        .mapInPandas(links, "u long, v long")
        .where("u <> v")
        .distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of ``links`` (u, v); root is the smallest node reachable.

    Alternating large-star and small-star steps (Kiveris et al., 2014): each is one grouping and
    one join, and each result is written to the shared folder, so a lost executor costs one step.
    A root of many nodes is split by the adaptive skew rule of the join.
    """
    edges = stage(links.select("u", "v").where("u <> v").distinct(), "links")
    before = None
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (
            both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        )
        down = large.distinct()
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        )
        edges = stage(small.where("u <> v").distinct(), "stars")
        now = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == before:
            break
        before = now
    return edges.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")


def component_table(fingerprints: DataFrame) -> DataFrame:
    """Rows (fp, root) for each distinct ``fp``, smallest reachable fingerprint as root."""
    distinct = fingerprints.select("fp").distinct()
    roots = components(spanning_links(distinct))
    return distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce("root", "fp").alias("root")
    )


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp, component_id) for every row of ``docs``.

    component_id is the smallest id reachable over links of at most three differing bits, itself
    included. A null or wordless text has fingerprint 0 and links like any other. Repeated rows
    stay repeated. A null id takes no part in the smallest id; a component of null ids only has a
    null component_id. Other columns are ignored, an empty table gives an empty result.
    """
    bound_batches(docs.sparkSession)
    prints = stage(
        docs.select(
            F.col(id_column).alias("id"), fingerprint_column(F.col(text_column), shingle).alias("fp")
        ),
        "fingerprints",
    )
    classes = stage(prints.groupBy("fp").agg(F.min("id").alias("first_id")), "classes")
    labelled = classes.join(component_table(classes), "fp")
    smallest = labelled.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = labelled.select("fp", "root").join(smallest, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(F.col("id").alias(id_column), "fp", "component_id")


def deduplicate(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """One row of every component: that of the smallest doc_id, null ids last.

    Ties between rows of one id are broken by the fingerprint; of rows equal in both one stays.
    Columns and their order are those of ``docs``.
    """
    bound_batches(docs.sparkSession)
    marked = stage(docs.withColumn("__fp", fingerprint_column(F.col("text"), shingle)), "marked")
    classes = stage(
        marked.groupBy(F.col("__fp").alias("fp")).agg(F.min("doc_id").alias("first_id")), "classes"
    )
    best = (
        classes.join(component_table(classes), "fp")
        .groupBy("root")
        .agg(F.min(F.struct(F.col("first_id").isNull().alias("none"), "first_id", "fp")).alias("best"))
        .select(F.col("best.fp").alias("__keep_fp"), F.col("best.first_id").alias("__keep_id"))
    )
    kept = marked.join(
        best, (F.col("__fp") == F.col("__keep_fp")) & F.col("doc_id").eqNullSafe(F.col("__keep_id"))
    )
    return kept.dropDuplicates(["__fp"]).select(*[F.col(f"`{c}`") for c in docs.columns])


def op10_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
