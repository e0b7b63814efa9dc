"""Toxicity by multiple-instance learning: sentences scored, documents labelled.

A sentence's probability is a logistic function of the words in it and of their beginnings, so
that inflected forms never seen before still count; a document is toxic unless
all its sentences are clean, so its probability is the noisy-or ``1 - prod(1 - p)``. Weights are
fitted by gradient descent on the likelihood of document labels alone, and the fitted sentence
probabilities then locate what offends.

The model is fitted on at most ``SAMPLE`` labelled documents, those of the smallest hash, and on
the ``VOCABULARY`` features whose document frequencies differ most between the labels. Every text is
scored whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from larder.llm.batches import bound_batches
from larder.sources.staging import stage

SAMPLE = 12_000
VOCABULARY = 2_000
MIN_DOCUMENTS = 5
THRESHOLD = 0.7
STEPS = 600
RATE = 0.1
PENALTY = 5e-5
SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"\w+")
PREFIXES = (4, 5, 6, 7)
_KNOWN_WORDS = 100_000
_TEXTS = 64


def features(word: str) -> list[str]:
    """The word, and its beginnings marked by a star."""
    return [word, *(word[:k] + "*" for k in PREFIXES if len(word) >= k)]


@dataclass
class Model:
    """Weights by word, and the bias; without training labels of both kinds every score is 0."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = float("-inf")

    def __post_init__(self):
        self._known: dict[str, tuple[str, ...]] = {}

    def hits(self, sentence: str) -> set[str] | None:
        """Features of the model in a sentence; None for one without a word."""
        words = set(WORD.findall(sentence.lower()))
        if not words:
            return None
        known, out = self._known, set()
        for word in words:
            found = known.get(word)
            if found is None:
                if len(known) > _KNOWN_WORDS:
                    known.clear()
                found = known[word] = tuple(f for f in features(word) if f in self.weights)
            if found:
                out.update(found)
        return out

    def score(self, text: str | None, threshold: float) -> tuple[float, list[tuple[int, int, float]]]:
        """Noisy-or over all sentences, and the sentences at or above ``threshold``."""
        if self.bias == float("-inf"):
            return 0.0, []
        spans, sums, plain = [], [], 0
        for m in SENTENCE.finditer(text or ""):
            hits = self.hits(m[0])
            if hits:
                spans.append(m.span())
                sums.append(sum(sorted(self.weights[f] for f in hits)))
            elif hits is not None:
                plain += 1
        logits = self.bias + np.array(sums)
        total = float(np.logaddexp(0, logits).sum()) + plain * float(np.logaddexp(0, self.bias))
        chances = 1 / (1 + np.exp(-logits))
        found = [(a, b, float(p)) for (a, b), p in zip(spans, chances) if p >= threshold]
        return float(-np.expm1(-total)), found


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learnt from; a null id has no label and is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _noisy_or_fit(y: np.ndarray, doc: np.ndarray, word: np.ndarray, sentence_doc: np.ndarray, plain: np.ndarray, n_words: int) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam on the mean log-likelihood of the documents.

    y: label of each document; doc, plain: documents and their number of sentences without a known
    word; sentence_doc: document of each other sentence; (doc, word): sentence and word of each hit.
    """
    w, bias = np.zeros(n_words + 1), -5.0
    w[-1] = bias
    first, second = np.zeros_like(w), np.zeros_like(w)
    n = max(1, len(y))
    for step in range(1, STEPS + 1):
        z = w[-1] + np.bincount(doc, weights=w[word], minlength=len(sentence_doc))
        soft = np.logaddexp(0, z)
        p = np.exp(z - soft)
        p0 = 1 / (1 + np.exp(-w[-1]))
        total = np.bincount(sentence_doc, weights=soft, minlength=len(y)) + plain * np.logaddexp(0, w[-1])
        slope = np.where(y == 1, np.exp(-total) / np.maximum(-np.expm1(-total), 1e-12), -1.0)
        by_sentence = slope[sentence_doc] * p
        gradient = np.append(
            np.bincount(word, weights=by_sentence[doc], minlength=n_words),
            by_sentence.sum() + (slope * plain * p0).sum(),
        ) / n
        gradient[:-1] -= PENALTY * w[:-1]
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        w = w + RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(d, y, text): at most ``sample`` rows, one for each chosen id, whatever repeats in ``docs``.

    Of rows under one id the text of the smallest hash is taken.
    """
    chosen = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max((F.col("toxic") == 1).cast("int")).alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    # At most `sample` narrow rows, whatever the input.
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "text"))
    return (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "y")
        .agg(one.alias("one"))
        .select(F.monotonically_increasing_id().alias("d"), F.col("y").cast("int").alias("y"), F.col("one.text").alias("text"))
    )


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic) outside the held-out third.

    Null labels and ids are left out; of several labels of a document the largest counts.
    """
    bound_batches(docs.sparkSession)
    texts = stage(labelled_sample(docs, labels, sample), "toxic-sample")
    sizes = dict(texts.groupBy("y").agg(F.count(F.lit(1))).collect())
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return Model()

    def distinct_features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            # A text has several times as many features as words, so few texts are held at a time.
            for low in range(0, len(batch), _TEXTS):
                part = batch.iloc[low : low + _TEXTS]
                found = {0: Counter(), 1: Counter()}
                for y, text in zip(part["y"], part["text"]):
                    found[y].update({f for w in set(WORD.findall(text.lower())) for f in features(w)})
                every = list(found[0].keys() | found[1].keys())
                yield pd.DataFrame(
                    {"word": every, "a": [found[1][f] for f in every], "b": [found[0][f] for f in every]}
                )

    counts = (
        texts.mapInPandas(distinct_features, "word string, a long, b long")
        .groupBy("word")
        .agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        .where(F.col("a") + F.col("b") >= MIN_DOCUMENTS)
    )
    share = (F.col("a") + F.col("b")) / (n1 + n0)
    lean = F.abs(F.col("a") / n1 - F.col("b") / n0) / F.sqrt(share * (1.0000001 - share) * (1 / n1 + 1 / n0))
    words = [r["word"] for r in counts.orderBy(lean.desc(), "word").limit(VOCABULARY).collect()]
    index = {w: i for i, w in enumerate(words)}

    known = Model({w: 0.0 for w in words})

    def hits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for d, y, text in zip(batch["d"], batch["y"], batch["text"]):
                plain, sentences = 0, []
                for m in SENTENCE.finditer(text):
                    found = known.hits(m[0])
                    if found:
                        sentences.append(sorted(index[f] for f in found))
                    elif found is not None:
                        plain += 1
                rows.append((d, y, plain, sentences))
            yield pd.DataFrame(rows, columns=["d", "y", "plain", "sentences"])

    # Ordered, so that the fit does not depend on where the sample's rows lie.
    got = texts.mapInPandas(hits, "d long, y int, plain long, sentences array<array<int>>")
    got = got.orderBy("y", "plain", F.xxhash64(F.to_json("sentences"))).toPandas()
    sentence_doc, doc, word = [], [], []
    for i, sentences in enumerate(got["sentences"]):
        for ids in sentences:
            doc += [len(sentence_doc)] * len(ids)
            word += list(ids)
            sentence_doc.append(i)
    as_ints = lambda x: np.array(x, dtype=np.int64)
    weights, bias = _noisy_or_fit(
        got["y"].to_numpy(), as_ints(doc), as_ints(word), as_ints(sentence_doc), got["plain"].to_numpy(), len(words)
    )
    return Model({w: float(x) for w, x in zip(words, weights)}, bias)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted and offending (spans in code points with their probability).

    One row for each row of ``docs``; a null or empty text scores as one without a sentence: 0.
    Only the text enters a score.
    """
    bound_batches(docs.sparkSession)
    scored = score_column(F.col("text"), model, threshold)
    return docs.select("doc_id", scored.alias("s")).select(
        "doc_id", "s.score", (F.col("s.score") >= THRESHOLD).cast("int").alias("predicted"), "s.offending"
    )


def score_column(text: Column, model: Model, threshold: float = THRESHOLD) -> Column:
    """struct<score, offending> of a text column."""

    @F.pandas_udf("score double, offending array<struct<start: int, end: int, score: double>>")
    def of(texts: pd.Series) -> pd.DataFrame:
        rows = [model.score(x, threshold) for x in texts]
        return pd.DataFrame(
            {
                "score": [s for s, _ in rows],
                "offending": [[{"start": a, "end": b, "score": p} for a, b, p in f] for _, f in rows],
            }
        )

    return of(text)


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose score is below ``THRESHOLD``, with its columns."""
    model = train(docs, labels)
    names = docs.columns
    marked = docs.withColumn("__score", score_column(F.col("text"), model)["score"])
    return marked.where(F.col("__score") < THRESHOLD).select(*[F.col(f"`{c}`") for c in names])


def op8_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        "predicted",
        F.size("offending").alias("n_offending"),
    )
