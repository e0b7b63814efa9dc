import math
import zlib
from collections import Counter

import pytest
import xxhash

from larder.llm import hashtree


def draw(key, level, name, weight):
    # Spark chains hashes: the first value's hash seeds the second's.
    h = xxhash.xxh64_intdigest(f"{hashtree.SEED}:{level}:{name}", 42)
    h = xxhash.xxh64_intdigest(key, h)
    return math.log(((h >> 12) + 0.5) / 2**52) / weight


def brute(doc_id, leaves):
    key, inside = "null" if doc_id is None else str(doc_id), list(leaves)
    for level in ("region", "rack", "shard"):
        sums = Counter()
        for x in inside:
            sums[getattr(x, level)] += x.weight
        won = max(sums, key=lambda n: (draw(key, level, n, sums[n]), -n))
        inside = [x for x in inside if getattr(x, level) == won]
    return inside[0].shard


ROWS = [(i * 7 - 50, f"text {i} é", "clash") for i in range(700)] + [(None, None, ""), (3, "", ""), (3, "", ""), (4, "x" * 100_000, "")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, shard string").repartition(3)


def test_assignment_against_brute_force(docs, monkeypatch):
    monkeypatch.setattr(hashtree, "SLOT_ROWS", 60)
    leaves = hashtree.tree(40)
    got = hashtree.assign(docs, leaves).collect()
    assert len(got) == len(ROWS)
    texts = {i: t or "" for i, t, _ in ROWS}
    for r in got:
        assert r["shard"] == brute(r["doc_id"], leaves)
        assert r["grown_shard"] == brute(r["doc_id"], hashtree.grow(leaves))
        assert r["grown_shard"] in (r["shard"], 40)
        data = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 16, zlib.crc32(data))
    for shard in range(40):
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert 3 <= sum(r["grown_shard"] == 40 for r in got) <= 40


def test_buckets_number_without_gaps(spark):
    df = spark.createDataFrame([(i % 3, i) for i in range(500)], "shard int, doc_id long")
    got = hashtree.with_slot(df, "doc_id", slot_rows=20).collect()
    for s in range(3):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))


def test_weights_and_confined_movement(spark):
    base = hashtree.tree(16, region_shards=8, rack_shards=4)
    heavy = tuple(hashtree.Leaf(x.region, x.rack, x.shard, 3.0 if x.shard == 5 else 1.0) for x in base)
    df = spark.range(20_000).withColumnRenamed("id", "doc_id")
    both = hashtree.with_shard(hashtree.with_shard(df, df["doc_id"], base, "old"), df["doc_id"], heavy, "new").collect()
    share = Counter(r["new"] for r in both)
    assert abs(share[5] / len(both) - 3 / 18) < 0.012
    region = {x.shard: x.region for x in base}
    rack = {x.shard: x.rack for x in base}
    for r in both:
        if r["old"] != r["new"]:
            # Rows only enter subtrees that grew, and racks of equal weight keep their rows.
            assert region[r["new"]] == 0 and (region[r["old"]] == 1 or rack[r["new"]] == 1)


def test_empty_table(docs):
    assert hashtree.assign(docs.limit(0), hashtree.tree(40)).count() == 0
    with pytest.raises(ValueError):
        hashtree.with_shard(docs, docs["doc_id"], ())
