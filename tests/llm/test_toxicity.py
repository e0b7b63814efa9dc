import random
import zlib

import pytest
from pyspark.sql import functions as F

from larder.llm import toxicity


def corpus():
    rng = random.Random(8)
    docs, labels = [], []
    for i in range(900):
        words = [f"w{rng.randrange(80)}" for _ in range(rng.randrange(5, 60))]
        toxic = int(rng.random() < 0.25)
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(("badone", "Worst", f"stem{rng.randrange(500)}"))
        text = "".join(w + rng.choice((" ", " ", " ", ". ")) for w in words)
        docs.append((i, text, "clash"))
        labels.append((i, toxic))
    docs += [(9001, None, ""), (9002, "", ""), (None, "badone", ""), (9003, ("fine words here. " * 9000) + "you badone.", ""), (3, docs[3][1], "")]
    return docs, labels


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string, score string")
    lab = spark.createDataFrame(labels + [(None, 1), (9002, None)], "doc_id long, toxic int")
    return docs, dict(labels), df, lab, toxicity.train(df, lab)


def test_held_out_accuracy_and_rows(fitted):
    docs, truth, df, _, model = fitted
    got = toxicity.score(df, model).withColumn("held", toxicity.held_out(F.col("doc_id"))).collect()
    assert len(got) == len(docs)
    held = [r for r in got if r["held"] and r["doc_id"] in truth]
    assert all(r["held"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got if r["doc_id"] is not None)
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) / len(held) > 0.95
    by = {r["doc_id"]: r for r in got}
    assert by[9001]["score"] == by[9002]["score"] == 0.0
    assert by[None]["predicted"] == 1 and not by[None]["held"]
    text = next(t for i, t, _ in docs if i == 9003)
    spans = by[9003]["offending"]
    assert by[9003]["predicted"] == 1 and [text[s["start"] : s["end"]].strip() for s in spans] == ["you badone"]


def test_score_is_the_noisy_or(fitted):
    model = toxicity.Model({"bad": 2.0, "worse": 3.0}, -1.0)
    p = lambda z: 1 / (1 + __import__("math").exp(-z))
    want = 1 - (1 - p(1.0)) * (1 - p(4.0)) * (1 - p(-1.0))
    score, found = model.score("Bad thing. bad, worse! Nothing here... ", 0.8)
    assert score == pytest.approx(want) and [round(x[2], 6) for x in found] == [round(p(4.0), 6)]


def test_held_out_labels_are_not_learnt(spark, fitted):
    docs, truth, df, lab, model = fitted
    flipped = lab.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.train(df, flipped) == model


def test_stage_and_empty_inputs(spark, fitted):
    _, _, df, lab, _ = fitted
    kept = toxicity.keep_clean(df, lab)
    assert kept.columns == df.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert 9003 not in ids and {9001, 9002} <= set(ids)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.keep_clean(df, none).count() == df.count()
    assert toxicity.score(df.limit(0), toxicity.train(df.limit(0), none)).count() == 0


def test_one_id_with_many_rows_is_one_row_of_the_sample(spark):
    copies = [(0, f"text {i % 7}" if i else None, "") for i in range(400)] + [(i, f"other {i}", "") for i in range(1, 12)]
    docs = spark.createDataFrame(copies, "doc_id long, text string, y string").repartition(5)
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)] + [(0, 1)], "doc_id long, toxic int")
    got = toxicity.labelled_sample(docs, labels).collect()
    wanted = [i for i in range(12) if zlib.crc32(str(i).encode()) % 3 != 1]
    assert 0 in wanted and len(got) == len(wanted) and len({r["d"] for r in got}) == len(got)
    assert sum(r["text"] == "" or r["text"].startswith("text") for r in got) == 1
    assert len(toxicity.labelled_sample(docs, labels, 3).collect()) == 3
