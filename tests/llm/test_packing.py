import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.llm import packing

tokenizers = pytest.importorskip("tokenizers")
PATH = packing.word_bpe_path()
TEXTS = [
    None, "", " \n", "Hello  World", "it's 3 o'clock, isn't it?", "été É", "a\x1cb\x1d c d\x85e",
    "<|endoftext|> x<|startoftext|>y <b>", "ǅ İ ß ΑΣ " * 3, "ab" * 5000, "word " * 3000, "日本語 ํ 한국어 ​﻿", "##,,''s 've",
]


def reference(text):
    t = tokenizers.Tokenizer.from_file(PATH)
    return t.encode(text or "", add_special_tokens=False).ids + [2]


def test_encoder_equals_the_tokenizer():
    encoder = packing.Encoder(PATH)
    assert encoder.by_word
    for _ in range(2):  # without and with known words
        got = [np.frombuffer(x, encoder.dtype).tolist() + [2] for x in encoder.encode([t or "" for t in TEXTS])]
        assert got == [reference(t) for t in TEXTS]


PARTS = [
    "A", "é", "E\u0301", "h\u0331", "H\u0331", "ß", "İ", "Σ", "ΑΣ", "σ", "ς", "'s", "'S", "'t", "'LL", "it's", ".", ",", "!", "a.", "B,",
    "c!?", "x;y", "1", "12", "ⅷ", "½", " ", " ", "\n", "\t", "\u00a0", "\u3000", "\x1c", "\x85", "\u2028", "<", "</s>", "日本", "Ж", "😀",
    "K", "ﬁ", "a" * 60, "_", "-", "w.\u00a0", "#",
]


def test_encoder_on_random_texts():
    rng = random.Random(4)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12))) for _ in range(15000)]
    encoder = packing.Encoder(PATH)
    assert encoder.by_word and encoder.direct
    want = encoder._each(texts)
    wrong = [(t, x, y) for t, x, y in zip(texts, encoder.encode(texts), want) if x != y]
    assert not wrong, wrong[:3]


def test_full_cache_keeps_results(monkeypatch):
    monkeypatch.setattr(packing, "_CACHE_WORDS", 3)
    encoder = packing.Encoder(PATH)
    for _ in range(3):
        for text in ("alpha beta gamma delta", "beta epsilon zeta eta alpha"):
            assert np.frombuffer(encoder.encode([text])[0], encoder.dtype).tolist() == reference(text)[:-1]


def turns_of(totals, window):
    """Pieces of all queues, and the deficits a sequential round-robin would carry."""
    total, low, out = sum(totals), 0, []
    for size in totals:
        out.append(list(packing.turns(0, size, low, size, total, window)))
        low += size
    return out


@pytest.mark.parametrize("totals,window", [([1000, 300, 17, 50], 64), ([5], 8), ([8, 8], 16), ([4097, 4095], 4096), ([999, 1, 1000], 2000)])
def test_turns_fill_windows_to_proportion(totals, window):
    pieces = turns_of(totals, window)
    total = sum(totals)
    used = {}
    for q, size in zip(pieces, totals):
        at, spent = 0, {}
        for a, b, r, offset in q:
            assert a == at and b > a
            at = b
            spent[r] = spent.get(r, 0) + b - a
            for i in range(offset, offset + b - a):
                assert used.setdefault((r, i), (q, size)) == (q, size) and 0 <= i < window
        assert at == size
        done = 0
        for r in range(-(-total // window)):
            done += spent.get(r, 0)
            assert abs(done - min((r + 1) * window, total) * size / total) < 1  # the deficit carried
    assert len(used) == total and max(used) == divmod(total - 1, window)


def test_pack_against_the_tokenizer(spark):
    rng = random.Random(7)
    rows = [(i, t, rng.choice(("s1", "s1", "s2", None)), "clash") for i, t in enumerate(TEXTS * 3)]
    rows += [(100, "rare source", "tiny", "x"), (None, "no id", "s2", "x"), (7, TEXTS[3], "s1", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, start string").repartition(3)
    window = 256
    got = packing.pack(df, PATH, window).withColumn("crc", F.crc32("tokens")).collect()
    by_doc = {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r)
    for i in {r[0] for r in rows} - {7}:
        ids = reference(next(t for j, t, *_ in rows if j == i))
        pieces = sorted(by_doc[i], key=lambda r: r["start"])
        assert [r["start"] for r in pieces] == [sum(x["length"] for x in pieces[:k]) for k in range(len(pieces))]
        for r in pieces:
            part = np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes()
            assert r["doc_tokens"] == len(ids) and bytes(r["tokens"]) == part and r["crc"] == zlib.crc32(part)
    assert sum(r["length"] for r in by_doc[7]) == len(reference(TEXTS[7])) + len(reference(TEXTS[3]))
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s, parts in sequences.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == window or s == max(sequences)


def test_small_sources_share_a_queue(spark):
    rows = [(i, "alpha beta " * 200, "big") for i in range(4)] + [(10 + i, "", f"s{i}") for i in range(5)] + [(20, "w " * 9, "mid")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = packing.pack(df, PATH, 64).collect()
    assert sum(r["length"] for r in got) == sum(len(reference(t)) for _, t, _ in rows)
    assert sorted(r["doc_id"] for r in got if r["source"].startswith("s")) == [10, 11, 12, 13, 14]


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string, source string"), PATH).count() == 0
