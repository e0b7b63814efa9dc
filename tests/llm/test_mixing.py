import math
import random

import pytest

from larder.llm import mixing


def rows():
    rng = random.Random(9)
    out = []
    for source, n in (("a", 400), ("b", 60), (None, 30), ("c", 100)):
        for _ in range(n):
            out.append((len(out), " ".join("w" for _ in range(rng.randrange(1, 40))), source, "clash"))
    return out + [(9000, None, "a", "x"), (9001, "", "empty", "x"), (None, "no id", "b", "x"), (5, out[5][1], "a", "x")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), "doc_id long, text string, source string, block string")


def narrow(docs):
    return docs.select("doc_id", "source", mixing.tokens_of(docs["text"]).alias("tokens"))


def totals():
    out = {}
    for _, t, s, _ in rows():
        out[s] = out.get(s, 0) + len((t or "").split())
    return {s: n for s, n in out.items() if n}


def brute_exponent(test):
    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if test(mid) else (low, mid)
    return low


def test_exponent_by_bisection(docs):
    t = totals()
    q = {s: n / sum(t.values()) for s, n in t.items()}

    def entropy(a):
        z = sum(x**a for x in q.values())
        return -sum(x**a / z * math.log(x**a / z) for x in q.values())

    table = mixing.source_totals(narrow(docs))
    a = mixing.find_exponent(table, repetition=2.0)
    assert a == pytest.approx(brute_exponent(lambda a: max(x ** (a - 1) for x in q.values()) / min(x ** (a - 1) for x in q.values()) > 2), abs=1e-6)
    a = mixing.find_exponent(table, entropy=1.2, repetition=None)
    assert a == pytest.approx(brute_exponent(lambda a: entropy(a) >= 1.2), abs=1e-6)
    assert mixing.find_exponent(table, entropy=9.0, repetition=None) == 0.0
    assert mixing.find_exponent(table, entropy=0.0, repetition=None) == 1.0


def test_blocks_are_permutations_within_budget(docs):
    n = narrow(docs)
    for targets in ({}, {"exponent": 0.3, "budget": 5000}, {"exponent": 0.0, "budget": 40_000}):
        plan = {r["source"]: r for r in mixing.plan(n, **targets).collect()}
        out = mixing.realise(n, mixing.plan(n, **targets)).collect()
        assert set(plan) == set(totals())
        assert sum(r["weight"] for r in plan.values()) == pytest.approx(1)
        for s, p in plan.items():
            mine = [r for r in out if r["source"] == s]
            total = sum(r["tokens"] for r in mine)
            longest = 80  # rows of one id stay together
            assert p["budget"] <= total < p["budget"] + longest
            full = sorted(str(r["doc_id"]) for r in n.where("source <=> " + (f"'{s}'" if s else "null")).collect())
            for b in range(p["full"]):
                assert sorted(str(r["doc_id"]) for r in mine if r["block"] == b) == full
            last = [r for r in mine if r["block"] == p["full"]]
            assert len({(r["doc_id"]) for r in last}) <= len(set(full))
            assert all(0 <= r["progress"] <= 1 for r in mine)
        if not targets:
            assert min(p["passes"] for p in plan.values()) == pytest.approx(1)
            assert max(p["passes"] for p in plan.values()) == pytest.approx(2, abs=0.02)
        # Blocks are different permutations.
        if targets.get("budget") == 40_000:
            order = [[r["doc_id"] for r in sorted((r for r in out if r["source"] == "b" and r["block"] == b), key=lambda r: r["place"])] for b in (0, 1)]
            assert order[0] != order[1]


def test_any_beginning_has_the_weights(docs):
    n = narrow(docs)
    plan = {r["source"]: r for r in mixing.plan(n).collect()}
    out = sorted(mixing.realise(n, mixing.plan(n)).where("tokens > 0").collect(), key=lambda r: r["progress"])
    half = [r for r in out if r["progress"] < 0.5]
    total = sum(r["tokens"] for r in half)
    for s, p in plan.items():
        assert sum(r["tokens"] for r in half if r["source"] == s) / total == pytest.approx(p["weight"], abs=0.05)


def test_mix_keeps_columns_and_every_row(spark, docs):
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    got = out.collect()
    assert {(r["doc_id"], r["text"], r["source"]) for r in got} == {r[:3] for r in rows()}
    assert mixing.mix(docs.limit(0)).count() == 0
    one = spark.createDataFrame([(1, "a b", "s")] * 3, "doc_id long, text string, source string")
    assert mixing.mix(one).count() == 3
