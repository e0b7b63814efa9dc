import random

import numpy as np
import pytest

from larder.llm import similar


def prose(rng, n):
    return [f"{rng.choice('abcdefgh')}word{rng.randrange(5000)}" for _ in range(n)]


def shingles(words):
    return {tuple(words[i : i + similar.SHINGLE]) for i in range(max(1, len(words) - similar.SHINGLE + 1))}


def edited(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return out


def likeness(a, b):
    return len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))


def test_prints_by_definition():
    for text in (None, "", " \n", "One", "a b c", "a b c d e f A B C D E F", "é x\x0by Z w v u " * 300):
        hashes = similar.shingle_hashes(text)
        words = (text or "").encode().lower().split()
        want = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
        assert len(hashes) == len(want)
        bits = int.from_bytes(similar.wide_print(text), "little")
        lanes = np.arange(1, 9, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)
        values = [int.from_bytes(similar._mixed(h + lanes).tobytes(), "little") for h in hashes]
        assert bits == sum(1 << b for b in range(similar.BITS) if 2 * sum(v >> b & 1 for v in values) > len(values))
    assert similar.wide_print("One  Two") == similar.wide_print("one two") != similar.wide_print("one three")


def test_recall_by_band_of_similarity_and_clean_texts():
    """Prints alone: pairs within the radius that agree on a band, and unrelated or half-equal pairs."""
    rng = random.Random(3)
    choices = similar._band_choices()
    found, all_ = {}, {}
    for _ in range(500):
        words = prose(rng, 300)
        for other in (edited(rng, words, rng.randrange(1, 9)), words[:150] + prose(rng, 150), prose(rng, 300)):
            s = likeness(words, other)
            band = "high" if s >= 0.9 else "near" if s >= 0.8 else "mid" if s >= 0.68 else "low"
            a, b = (np.frombuffer(similar.wide_print(" ".join(w)), np.uint8) for w in (words, other))
            differ = np.unpackbits(a ^ b, bitorder="little")
            hit = differ.sum() <= similar.RADIUS and (differ[choices].sum(axis=1) == 0).any()
            found[band] = found.get(band, 0) + hit
            all_[band] = all_.get(band, 0) + 1
    assert all_["high"] > 50 and all_["near"] > 50
    assert found["high"] / all_["high"] >= 0.98
    assert found["near"] / all_["near"] >= 0.9
    assert found["low"] == 0


def test_forest_keeps_every_component():
    rng = random.Random(5)
    for _ in range(60):
        values = [rng.getrandbits(10) for _ in range(rng.randrange(0, 25))]
        tree = list(dict.fromkeys(values[: len(values) // 2 + 3]))
        probes = tree if rng.random() < 0.4 else list(dict.fromkeys(values[len(values) // 2 :]))
        want = {v: v for v in tree + probes}
        got = dict(want)

        def find(root, x):
            while root[x] != x:
                x = root[x]
            return x

        for p in probes:
            for t in tree:
                if (p ^ t).bit_count() <= 2:
                    a, b = find(want, p), find(want, t)
                    want[max(a, b)] = min(a, b)
        for u, v in similar._forest(tree, probes, 2):
            assert (u ^ v).bit_count() <= 2
            a, b = find(got, u), find(got, v)
            assert a != b
            got[max(a, b)] = min(a, b)
        assert all(find(want, x) == find(got, x) for x in want)


@pytest.mark.parametrize("tree_nodes", [4096, 3])
def test_groups_by_brute_force(spark, monkeypatch, tree_nodes):
    rng = random.Random(7)
    rows = [(i, " ".join(prose(rng, 120))) for i in range(40)]
    base = prose(rng, 400)
    rows += [(100 + i, " ".join(edited(rng, base, i % 4))) for i in range(40)]
    rows += [(200, None), (201, ""), (202, "  "), (203, "one two"), (204, "One\ttwo"), (None, "one two"), (100, " ".join(base)), (300, "long " * 60_000)]
    rng.shuffle(rows)
    monkeypatch.setattr(similar.similar_links, "__defaults__", (similar.RADIUS, tree_nodes))
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, row long").repartition(3)
    kept = similar.deduplicate(df)
    assert kept.columns == df.columns
    got = sorted(r["doc_id"] for r in kept.collect())
    assert got == [*range(40), 100, 200, 203, 300]


def test_empty_table_and_null_ids(spark):
    assert similar.deduplicate(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    df = spark.createDataFrame([(None, "a b"), (None, "a b"), (None, "c d")], "doc_id long, text string")
    assert sorted(r["text"] for r in similar.deduplicate(df).collect()) == ["a b", "c d"]


def test_routing_keys_meet_similar_texts_and_no_others():
    """Recall of pairs within the radius by shared keys; unrelated texts share none, so candidates grow with the copies."""
    rng = random.Random(11)
    found, all_ = {}, {}
    for _ in range(400):
        words = prose(rng, 300)
        other = edited(rng, words, rng.randrange(1, 9))
        s = likeness(words, other)
        band = "high" if s >= 0.9 else "near" if s >= 0.8 else "low"
        a, b = (" ".join(w) for w in (words, other))
        differ = np.unpackbits(np.frombuffer(similar.wide_print(a), np.uint8) ^ np.frombuffer(similar.wide_print(b), np.uint8))
        shared = (similar.route_keys(similar.shingle_hashes(a)) == similar.route_keys(similar.shingle_hashes(b))).any()
        found[band] = found.get(band, 0) + (shared and differ.sum() <= similar.RADIUS)
        all_[band] = all_.get(band, 0) + 1
    assert all_["high"] > 50 and all_["near"] > 50
    assert found["high"] / all_["high"] >= 0.99
    assert found["near"] / all_["near"] >= 0.93
    keys = np.concatenate([similar.route_keys(similar.shingle_hashes(" ".join(prose(rng, 40)))) for _ in range(4000)])
    assert len(np.unique(keys)) == len(keys) == 4000 * similar.ROUTES
    assert len(similar.route_keys(similar.shingle_hashes(" "))) == 0


def test_unrelated_texts_give_no_shared_keys(spark, monkeypatch):
    rng = random.Random(17)
    rows = [(i, " ".join(prose(rng, 30))) for i in range(1500)]
    rows += [(5000 + i, rows[i][1] + " end") for i in range(5)]
    written = {}

    def kept(df, name, *rest):
        written[name] = table = staged(df, name, *rest)
        return table

    staged = similar.stage
    monkeypatch.setattr(similar, "stage", kept)
    left = {r["doc_id"] for r in similar.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert left == set(range(1500))
    # Bit bands would have some hundred pairs of unrelated prints to compare.
    assert written["shared-keys"].count() <= 5 * similar.ROUTES


def test_prints_alone_are_routed_by_bit_bands(spark):
    rng = random.Random(19)
    words = prose(rng, 200)
    texts = [" ".join(words), " ".join(edited(rng, words, 1)), " ".join(prose(rng, 200))]
    prints = spark.createDataFrame([(bytearray(similar.wide_print(x)),) for x in texts], "print binary")
    links = [{bytes(r["u"]), bytes(r["v"])} for r in similar.similar_links(prints).collect()]
    assert links and all(pair == {similar.wide_print(x) for x in texts[:2]} for pair in links)
