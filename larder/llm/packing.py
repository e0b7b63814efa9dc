"""Mixture-controlled packing of token sequences by deficit round-robin over source queues.

Every source is a queue of its documents' tokens. With each window of ``WINDOW`` tokens a queue's
deficit grows by its share of the corpus; it spends whole tokens and carries the rest into the
next window. All queues therefore fill every window to their proportions (to the token), run dry
together in the last one, and leave no padding before it. Documents are cut where a queue's turn
or a window ends.

Since shares are known, where a turn begins follows from totals alone: after t tokens the queues
up to one whose cumulated share is P of T have emitted ``floor(t * P / T)`` tokens together. A
piece's window and offset are thus computed beside its document. Tasks number the tokens of each
source as they tokenise; the totals per (source, task) shift these numbers onto the queue, which
carries deficits across tasks as across windows. Only these totals are shuffled.

A queue needs a token a window for its turns to be well defined; sources with less share one
common queue. So there are at most ``WINDOW`` + 1 queues.
"""

from __future__ import annotations

import os
import struct
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from larder.llm.batches import bound_batches
from larder.sources.staging import stage

WINDOW = 4096
END_ID = 2
#: Texts that are encoded whole: with white space that tokenizers' \s does not know, or with marks
#: that join a letter, as they stand or in lower case (they compose by case, and join other marks).
_ODD = r"[\x1c-\x1f\pMİ]"
_CACHE_WORDS = 600_000
_CACHE_LENGTH = 48
_BATCH_CHARS = 2_000_000

#: Words on which the short way to the model is tried.
_PROBES = ("Hello", "hello", "a", "Straße", "ÉCOLE", "naïve", "Ångström", "日本語", "ΩΜΕΓΑ", "ждать", "longishwordofmanyparts")


def _byte_chars() -> dict[int, str]:
    """The character that byte-level tokenizers write for each byte: itself where it prints."""
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printed]
    return {b: chr(b) for b in printed} | {b: chr(256 + i) for i, b in enumerate(rest)}


_CHAR_OF = [_byte_chars()[b] for b in range(256)]


def _plain(word: str) -> bool:
    """Composed, and lowered letter by letter."""
    return unicodedata.is_normalized("NFC", word) and "Σ" not in word and "İ" not in word


class Encoder:
    """Token ids of texts as little-endian bytes (two a token where the vocabulary allows it).

    A tokenizer that drops white space encodes word by word, so words seen before are looked up.
    Any other one encodes whole texts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype, self.code = ("<u2", "H") if self.tokenizer.get_vocab_size() <= 1 << 16 else ("<u4", "I")
        self.cache: dict[str, bytes] = {}
        special = self.tokenizer.get_added_tokens_decoder()
        self.mark, self.mark_id = next(((t.content, i) for i, t in special.items()), (None, None))
        alone = lambda x: self.tokenizer.encode(x, add_special_tokens=False).ids
        self.by_word = alone("a b") == alone("a\n\t b ") == alone("a") + alone("b") and alone(" .") == alone(".")
        # Words of letters can go straight to the model if it then gives the same ids.
        self.direct = self.by_word and all(
            run == self._bytes(alone(w)) and alone(w + c) == alone(w) + alone(c)
            for w, run in self._direct(list(_PROBES)).items()
            for c in ".,!?;:"
        )

    def _bytes(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.code}", *ids)

    def _direct(self, words: list[str]) -> dict[str, bytes]:
        """Ids of the words that are letters only."""
        tokenize, ids, ends, done = self.tokenizer.model.tokenize, [], [0], []
        for word in words:
            if word.isalpha():
                if word.isascii():
                    mapped = word.lower()
                elif _plain(word):
                    mapped = "".join([_CHAR_OF[b] for b in word.lower().encode()])
                else:
                    continue
                ids += [t.id for t in tokenize(mapped)]
                ends.append(len(ids))
                done.append(word)
        size, data = struct.calcsize(self.code), np.array(ids, self.dtype).tobytes()
        return {word: data[a * size : b * size] for word, a, b in zip(done, ends, ends[1:])}

    def _each(self, texts: list[str]) -> list[bytes]:
        return [self._bytes(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """Words of letters go to the model; others are encoded as one text with marks between."""
        out = self._direct(words) if self.direct else {}
        words = [w for w in words if w not in out]
        if self.mark is None:
            return out | dict(zip(words, self._each(words)))
        plain = [w for w in words if "<" not in w]
        if plain:
            text = self.mark.join(plain)
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=self.dtype)
            ends = np.append(np.flatnonzero(ids == self.mark_id), len(ids)).tolist()
            if len(ends) == len(plain):
                data, size, start = ids.tobytes(), ids.itemsize, 0
                for word, end in zip(plain, ends):
                    out[word] = data[start * size : end * size]
                    start = end + 1
        rest = [w for w in words if w not in out]
        out.update(zip(rest, self._each(rest)))
        return out

    def _runs(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words, looked up or learnt."""
        if len(self.cache) > _CACHE_WORDS:  # words of this batch are likely to come again
            self.cache = {w: self.cache[w] for w in words if w in self.cache}
        look = self.cache.get
        found = [look(w) for w in words]
        learnt = self._learn([w for w, run in zip(words, found) if run is None])
        self.cache.update((w, b) for w, b in learnt.items() if len(w) <= _CACHE_LENGTH)
        return [learnt[w] if run is None else run for w, run in zip(words, found)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Words are split and numbered in Arrow; only a batch's distinct words are looked at one by one."""
        if not self.by_word:
            return self._each(texts)
        column = pa.array(texts, pa.large_string())
        odd = pc.match_substring_regex(column, _ODD)
        column = pc.if_else(odd, "", column)
        if self.direct:
            # Fewer distinct words: no capital letters, no mark behind a word.
            column = pc.replace_substring_regex(pc.ascii_lower(column), r"(\pL)([.,!?;:])(\s|$)", r"\1 \2\3")
        split = pc.utf8_split_whitespace(column)
        coded = split.values.dictionary_encode()
        index = coded.indices.to_numpy()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        blank = words.index("") if "" in words else None  # outer white space
        runs = self._runs([w for w in words if w])
        if blank is not None:
            runs.insert(blank, b"")
        ends = np.append(0, np.cumsum(np.fromiter(map(len, runs), np.int64, len(runs))[index]))
        ids = b"".join([runs[i] for i in index.tolist()])
        borders = ends[split.offsets.to_numpy()].tolist()
        out = [ids[a:b] for a, b in zip(borders, borders[1:])]
        for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist():
            out[i] = self._each([texts[i]])[0]
        return out


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """One for each worker process, so that words stay known from task to task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def tokenise(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, source, part, at, n, ids, width): ids with the end token, as bytes of ``width`` a token.

    ``part`` is the task and ``at`` the number of tokens of the same source before the document in
    it. Must be written before use, as ``at`` belongs to one run of the task.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(tokenizer_path)
        end = encoder._bytes([END_ID])
        width = len(end)
        part = TaskContext.get().partitionId()
        seen: dict[str | None, int] = {}
        for batch in batches:
            texts = [x or "" for x in batch["text"]]
            low = 0
            while low < len(texts):
                high, chars = low, 0
                while high < len(texts) and (high == low or chars + len(texts[high]) <= _BATCH_CHARS):
                    chars += len(texts[high])
                    high += 1
                ids = [x + end for x in encoder.encode(texts[low:high])]
                rows = batch.iloc[low:high]
                at = []
                for source, x in zip(rows["source"], ids):
                    at.append(seen.get(source, 0))
                    seen[source] = at[-1] + len(x) // width
                yield pd.DataFrame(
                    {
                        "doc_id": rows["doc_id"],
                        "source": rows["source"],
                        "part": part,
                        "at": at,
                        "n": [len(x) // width for x in ids],
                        "ids": ids,
                        "width": width,
                    }
                )
                low = high

    # Ids travel as strings, since pandas turns integers with nulls into floats.
    return docs.select(F.col("doc_id").cast("string"), "source", "text").mapInPandas(
        run, "doc_id string, source string, part int, at long, n long, ids binary, width int"
    )


def _queues(tokens: DataFrame, window: int) -> DataFrame:
    """(source, part, base, low, size, total): where a task's tokens of a source begin in their queue.

    low and size are the queue's place in the cumulated totals of all queues.
    """
    pieces = tokens.groupBy("source", "part").agg(F.sum("n").alias("n"))
    pieces = pieces.withColumn("in_source", F.sum("n").over(W.partitionBy("source").orderBy("part")) - F.col("n"))
    sources = pieces.groupBy("source").agg(F.sum("n").alias("n"))
    total = sources.agg(F.sum("n").alias("total"))
    ranked = (
        sources.join(F.broadcast(total))  # one row
        .withColumn("small", F.col("n").cast("decimal(38,0)") * window < F.col("total"))
    )
    # The smallest full source joins the common queue while that has under a token a window.
    common = ranked.agg(
        F.sum(F.when(F.col("small"), F.col("n")).otherwise(0)).alias("common"),
        F.min(F.when(~F.col("small"), F.struct("n", F.col("source").isNull().alias("none"), "source"))).alias("least"),
    )
    thin = (F.col("common") > 0) & (F.col("common").cast("decimal(38,0)") * window < F.col("total"))
    is_least = F.col("least").isNotNull() & F.col("source").eqNullSafe(F.col("least.source"))
    ranked = ranked.join(F.broadcast(common)).withColumn("shared", F.col("small") | (thin & is_least))  # one row
    in_common = F.sum("n").over(W.partitionBy("shared").orderBy(F.col("source").isNull(), "source")) - F.col("n")
    ranked = ranked.withColumn("in_queue", F.when(F.col("shared"), in_common).otherwise(0))
    ranked = ranked.withColumn("queue", F.when(~F.col("shared"), F.to_json(F.struct("source"))))
    queues = ranked.groupBy("shared", "queue").agg(F.sum("n").alias("size"))  # at most window + 1 rows
    queues = queues.withColumn("low", F.sum("size").over(W.orderBy("shared", "queue")) - F.col("size"))
    placed = ranked.join(
        queues.select(F.col("shared").alias("qs"), F.col("queue").alias("qq"), "size", "low"),
        (F.col("shared") == F.col("qs")) & F.col("queue").eqNullSafe(F.col("qq")),
    ).select(F.col("source").alias("s"), "in_queue", "size", "low", "total")
    return pieces.join(placed, F.col("source").eqNullSafe(F.col("s"))).select(
        F.col("s").alias("q_source"),
        F.col("part").alias("q_part"),
        (F.col("in_source") + F.col("in_queue")).alias("base"),
        "size",
        "low",
        "total",
    )


def turns(a: int, b: int, low: int, size: int, total: int, window: int) -> Iterator[tuple[int, int, int, int]]:
    """(from, to, window, offset) of the pieces of a queue's tokens a..b."""

    def spent(r: int) -> tuple[int, int]:
        """Tokens of the queue, and of the queues before it, after r windows."""
        t = min(r * window, total)
        before = t * low // total
        return t * (low + size) // total - before, before

    r = a * total // size // window
    while spent(r)[0] > a:
        r -= 1
    while spent(r + 1)[0] <= a:
        r += 1
    had, before = spent(r)
    while a < b:
        have, after = spent(r + 1)
        if have > a:
            to = min(b, have)
            yield a, to, r, after - before + a - had
            a = to
        r, had, before = r + 1, have, after


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW) -> DataFrame:
    """Pieces: doc_id, source, start, length, tokens, doc_tokens, sequence_id, offset.

    Each token of each row of ``docs`` (text and end token) lies in one piece; ``tokens`` holds a
    piece's ids as little-endian unsigned 32-bit numbers. Sequences are full but for the last. A
    null or empty text has its end token only; a null source is a source; repeated rows are packed
    each; an empty table gives no piece.
    """
    bound_batches(docs.sparkSession)
    tokens = stage(tokenise(docs, tokenizer_path), "tokens")
    queues = stage(_queues(tokens, window), "queues")
    placed = tokens.join(
        queues, tokens["source"].eqNullSafe(F.col("q_source")) & (F.col("part") == F.col("q_part"))
    ).select("doc_id", "source", "at", "n", "ids", "width", "base", "size", "low", "total")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["doc_id", "source", "start", "length", "tokens", "doc_tokens", "sequence_id", "offset"]
        rows, held = [], 0
        for batch in batches:
            ids_of = batch["doc_id"]
            for i, (source, at, n, ids, width, base, size, low, total) in enumerate(
                zip(*(batch[c].tolist() for c in batch.columns[1:]))
            ):
                wide = np.frombuffer(ids, f"<u{width}").astype("<u4")
                first = base + at
                for a, b, r, offset in turns(first, first + n, low, size, total, window):
                    a, b = a - first, b - first
                    rows.append((ids_of.iat[i], source, a, b - a, wide[a:b].tobytes(), n, r, offset))
                held += 4 * n
                if len(rows) >= 50_000 or held > 32_000_000:
                    yield pd.DataFrame(rows, columns=names)
                    rows, held = [], 0
        yield pd.DataFrame(rows, columns=names)

    kind = dict(docs.dtypes)["doc_id"]
    return placed.mapInPandas(
        cut,
        "doc_id string, source string, start long, length long, tokens binary, doc_tokens long, sequence_id long, offset long",
    ).withColumn("doc_id", F.col("doc_id").cast(kind))


def word_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op5_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(docs, word_bpe_path()).select(
        "doc_id",
        "start",
        "length",
        F.crc32("tokens").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "source",
    )
