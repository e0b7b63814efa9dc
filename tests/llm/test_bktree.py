import random

import xxhash

from larder.llm import bktree


def brute_fingerprint(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode()
    words = [w for w in __import__("re").split(rb"[\x20\x09-\x0d]+", words) if w]
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    values = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def brute_components(fps):
    """{index: smallest index reachable}"""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_fingerprint_matches_definition():
    for text in (None, "", " \n", "One", "a b", "É Straße x\x0by Z", "one two three four one two three " * 9):
        assert bktree.fingerprint(text) & (2**64 - 1) == brute_fingerprint(text)


def test_tree_finds_all_within_radius():
    rng = random.Random(1)
    centre = [rng.getrandbits(64) for _ in range(20)]
    values = [c ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(6))) for c in centre for _ in range(20)]
    tree = bktree.BKTree(values)
    for probe in values[::7]:
        assert sorted(tree.within(probe, 3)) == sorted({v for v in values if (v ^ probe).bit_count() <= 3})


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(12):
        words = [rng.choice(vocabulary) for _ in range(rng.choice((3, 40, 300)))]
        for _ in range(8):
            copy = list(words)
            for _ in range(rng.randrange(3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    texts += [None, "", "  ", "x", "X", "x y", "long " * 30_000]
    rows = [(i * 3, t, "clash") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = {r["doc_id"]: (r["fp"] & (2**64 - 1), r["component_id"]) for r in bktree.near_duplicates(df).collect()}
    fps = [brute_fingerprint(t) for t in texts]
    want = brute_components(fps)
    assert got == {i * 3: (fps[i], want[i] * 3) for i in range(len(texts))}


def test_split_buckets_lose_no_link(spark):
    rng = random.Random(3)
    base = rng.getrandbits(63)
    values = {base}
    while len(values) < 120:
        values.add(rng.choice(sorted(values)) ^ sum(1 << b for b in {rng.randrange(63) for _ in range(3)}))
    values = sorted(values) + [rng.getrandbits(63) for _ in range(80)]
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    for nodes in (7, 4096):
        links = bktree.spanning_links(df, nodes)
        assert links.count() <= 10 * len(values)
        got = {r["node"]: r["root"] for r in bktree.components(links).collect()}
        want = brute_components(values)
        for i, v in enumerate(values):
            assert got.get(v, v) == values[want[i]]


def test_deduplicate_keeps_one_of_each(spark):
    text = "one two three four five six seven " * 4
    rows = [(5, text), (2, text), (2, text), (None, text), (None, None), (9, "other words altogether here"), (None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = bktree.deduplicate(df)
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(2, text), (9, rows[5][1]), (None, "")], key=str) or sorted(
        map(tuple, got.collect()), key=str
    ) == sorted([(2, text), (9, rows[5][1]), (None, None)], key=str)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bktree.near_duplicates(df).count() == 0
    assert bktree.deduplicate(df).count() == 0
