"""Personal data by base patterns and a semi-Markov conditional random field.

Four base patterns give spans that always stay. A base pattern takes the longest run of its
characters, so a phone number in front of a card number is one run with too many digits, and both
are lost. Such places are handed to a semi-Markov conditional random field (Sarawagi and Cohen,
2004): a labelling cuts a place into words outside and segments of a kind; a segment is scored as a
whole (number of digits, check digit, address parts, brackets, separators, neighbours), and dynamic
programming over segments of at most ``MAX_TOKENS`` words chooses borders and kinds together.

The model is fitted by conditional likelihood on places whose base spans are undisputed, on pairs
of such spans put side by side, and on examples generated by rule, which keep every kind known
whatever the table holds. Base spans inside a place are fixed; only what lies between is labelled.
"""

from __future__ import annotations

import hashlib
import itertools
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from larder.llm.batches import bound_batches
KINDS = ("email", "ip", "card", "phone")
#: Longest segment in words (runs of letters, runs of digits, single marks).
MAX_TOKENS = 24
#: A segment of fewer digits and without ``@`` is no candidate.
MIN_DIGITS = 7
#: Bounds of the sample that the model is fitted on: texts, places of a text, places in all, their length.
SAMPLE_TEXTS, SAMPLE_PER_TEXT, SAMPLE, SAMPLE_CHARS = 4000, 4, 1500, 160
GENERATED = 150
STEPS, RIDGE = 60, 0.02
SEED = 13

_CHUNK = re.compile(r"[0-9][0-9.\x20-]*+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|[^\sA-Za-z0-9]")
_EMAIL_SHAPE = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP_SHAPE = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_PLACE = _LOCAL | frozenset("@()")
_NUMBER_START = frozenset("0123456789+(")
_NUMBER_END = frozenset("0123456789)")


def digits_of(text: str) -> str:
    return _NOT_DIGIT.sub("", text)


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2])
    return (total + sum((2 * int(d) - 1) % 9 + 1 if d != "0" else 0 for d in digits[-2::-2])) % 10 == 0


def _is_byte(part: str) -> bool:
    short = part.lstrip("0")
    return len(short) <= 3 and int(short or "0") <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """A local part is the whole run before an ``@``, back to the match before."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        done = domain.end() if domain else at + 1
        at = text.find("@", done)


def base_spans(text: str) -> tuple[list[list[tuple[int, int]]], list[tuple[int, int]]]:
    """Spans of each kind, and matches that failed their test. Each pattern is read in linear time."""
    emails = list(_emails(text))
    ips, cards, phones, failed = [], [], [], []
    for chunk in _CHUNK.finditer(text):
        low, high = chunk.span()
        if high - low < 7:
            continue
        for m in _IP.finditer(text, low, high):
            (ips if all(map(_is_byte, m.group().split("."))) else failed).append(m.span())
        if high - low < 16:
            continue
        for m in _CARD.finditer(text, low, high):
            number = digits_of(m.group())
            if 16 <= len(number) <= 19 and luhn(number):
                cards.append(m.span())
            elif len(number) >= 16:
                failed.append(m.span())
    if "+" in text:
        for m in _PHONE.finditer(text):
            (phones if 8 <= len(digits_of(m.group())) <= 15 else failed).append(m.span())
    return [emails, ips, cards, phones], failed


def _around(text: str, low: int, high: int, done: int) -> tuple[int, int]:
    """The place of a trigger: a run of address and number characters, over single blanks between numbers."""
    while low > done:
        c = text[low - 1]
        if c in _PLACE or (c == " " and text[low] in _NUMBER_START and low - 1 > done and text[low - 2] in _NUMBER_END):
            low -= 1
        else:
            break
    size = len(text)
    while high < size:
        c = text[high]
        if c in _PLACE or (c == " " and text[high - 1] in _NUMBER_END and high + 1 < size and text[high + 1] in _NUMBER_START):
            high += 1
        else:
            break
    return low, high


def places(text: str, known: list[tuple[int, int]], unknown_only: bool) -> Iterator[tuple[int, int]]:
    """Places that may hold a segment; with ``unknown_only`` those not explained by known spans."""
    triggers = [m.span() for m in _CHUNK.finditer(text) if m.end() - m.start() >= MIN_DIGITS]
    triggers = [(a, b) for a, b in triggers if len(digits_of(text[a:b])) >= MIN_DIGITS]
    triggers += [(p, p + 1) for p in _positions(text, "@")] + [(p, p + 1) for p in _positions(text, "+")]
    if not unknown_only:
        triggers += known
    covered, at = sorted(known), 0
    done = 0
    for low, high in sorted(triggers):
        if unknown_only:
            while at < len(covered) and covered[at][1] <= low:
                at += 1
            if at < len(covered) and covered[at][0] <= low and len(text[low:high].rstrip(" .-")) <= covered[at][1] - low:
                continue
        if low < done:
            continue
        low, high = _around(text, low, high, done)
        done = high
        yield low, high


def _positions(text: str, mark: str) -> Iterator[int]:
    at = text.find(mark)
    while at >= 0:
        yield at
        at = text.find(mark, at + 1)


# --- Segments and their features ---------------------------------------------------------


def _bucket(n: int, ends: tuple[int, ...]) -> int:
    return sum(n > e for e in ends)


_DIGIT_ENDS = (0, 3, 6, 7, 8, 9, 10, 11, 12, 13, 15, 16, 17, 19)
_FEATURES: dict[tuple, int] = {}


def _feature_names() -> Iterator[tuple]:
    yield ("bias",)
    for name, n in (("digits", 15), ("groups", 7), ("longest", 7), ("blanks", 5), ("dots", 5), ("marks", 4), ("at", 3), ("words", 4)):
        yield from ((name, i) for i in range(n))
    for name in ("first", "last", "before", "after"):
        yield from ((name, c) for c in ("digit", "letter", "plus", "open", "blank", "edge", "known", "joint", "other"))
    for name in ("luhn", "email", "ip", "octets", "brackets", "number"):
        yield from ((name, v) for v in (False, True))


_FEATURES.update((name, i) for i, name in enumerate(_feature_names()))


def _class(c: str) -> str:
    if "0" <= c <= "9":
        return "digit"
    if c.isascii() and c.isalpha():
        return "letter"
    return {"+": "plus", "(": "open", " ": "blank", ".": "joint", "-": "joint", "_": "joint", "@": "joint"}.get(c, "other")


def segment_features(text: str, before: str, after: str) -> list[int]:
    """Indices of the features of a whole segment and its two neighbours."""
    digits = digits_of(text)
    groups = [g for g in _NOT_DIGIT.split(text) if g]
    at = text.count("@")
    ip = bool(_IP_SHAPE.fullmatch(text))
    numeric = not any(c.isalpha() for c in text) and not at
    names = [
        ("bias",),
        ("digits", _bucket(len(digits), _DIGIT_ENDS)),
        ("groups", min(len(groups), 6)),
        ("longest", _bucket(max(map(len, groups), default=0), (0, 3, 4, 8, 15, 19))),
        ("blanks", min(text.count(" "), 4)),
        ("dots", min(text.count("."), 4)),
        ("marks", min(len(set(text) & set(" .-")), 3)),
        ("at", min(at, 2)),
        ("words", _bucket(sum(c.isalpha() for c in text), (0, 3, 12))),
        ("first", _class(text[0])),
        ("last", _class(text[-1])),
        ("before", before),
        ("after", after),
        ("luhn", numeric and 16 <= len(digits) <= 19 and luhn(digits)),
        ("email", bool(_EMAIL_SHAPE.fullmatch(text))),
        ("ip", ip),
        ("octets", ip and all(map(_is_byte, text.split(".")))),
        ("brackets", text.count("(") == text.count(")") and text.find("(") <= text.find(")")),
        ("number", numeric and 8 <= len(digits) <= 15),
    ]
    return [_FEATURES[n] for n in names]


_WIDTH = len(segment_features("0", "edge", "edge"))


@dataclass
class Piece:
    """Tokens of a text between fixed spans, and the candidate segments (first and last token)."""

    spans: list[tuple[int, int]]
    segments: list[tuple[int, int]]
    features: list[list[int]]


def pieces_of(text: str, left: str = "edge", right: str = "edge") -> Piece:
    spans = [m.span() for m in _TOKEN.finditer(text)]
    digits = np.cumsum([0] + [b - a if "0" <= text[a] <= "9" else 0 for a, b in spans]).tolist()
    marks = np.cumsum([0] + [text[a] == "@" for a, _ in spans]).tolist()
    starts = [i for i, (a, _) in enumerate(spans) if text[a] in "+(" or (text[a].isascii() and text[a].isalnum())]
    segments, features = [], []
    for i in starts:
        for j in range(i, min(i + MAX_TOKENS, len(spans))):
            a, b = spans[i][0], spans[j][1]
            last = text[b - 1]
            if not (last.isascii() and last.isalnum()) or digits[j + 1] - digits[i] < MIN_DIGITS and marks[j + 1] == marks[i]:
                continue
            before = _class(text[a - 1]) if a else left
            after = _class(text[b]) if b < len(text) else right
            segments.append((i, j))
            features.append(segment_features(text[a:b], before, after))
    return Piece(spans, segments, features)


# --- The model -----------------------------------------------------------------------------


@dataclass
class Model:
    """Weights by kind and feature, and by a label and the one before it (0 is outside)."""

    weights: np.ndarray
    moves: np.ndarray

    def best(self, piece: Piece) -> list[tuple[int, int, int]]:
        """(first token, last token, kind) of the best labelling, by dynamic programming."""
        n, labels = len(piece.spans), len(KINDS) + 1
        if not piece.segments:
            return []
        value = self.weights[:, np.array(piece.features)].sum(axis=2).T  # segments by kinds
        ending: list[list[int]] = [[] for _ in range(n + 1)]
        for s, (_, j) in enumerate(piece.segments):
            ending[j + 1].append(s)
        best = np.full((n + 1, labels), -np.inf)
        best[0, 0] = 0.0
        back: list[list[tuple[int, int, int] | None]] = [[None] * labels for _ in range(n + 1)]
        for e in range(1, n + 1):
            reach = best[e - 1] + self.moves[:, 0]
            best[e, 0] = reach.max()
            back[e][0] = (e - 1, int(reach.argmax()), -1)
            for s in ending[e]:
                i = piece.segments[s][0]
                for kind in range(len(KINDS)):
                    reach = best[i] + self.moves[:, kind + 1]
                    score = reach.max() + value[s, kind]
                    if score > best[e, kind + 1]:
                        best[e, kind + 1] = score
                        back[e][kind + 1] = (i, int(reach.argmax()), s)
        out, e, label = [], n, int(best[n].argmax())
        while e:
            i, before, s = back[e][label]
            if s >= 0:
                out.append((*piece.segments[s], label - 1))
            e, label = i, before
        return out[::-1]


class Lattice:
    """All examples at once: their candidate segments by place, for expected counts of features."""

    def __init__(self, examples: list[tuple[Piece, list[tuple[int, int, int]]]]):
        self.sizes = np.array([len(p.spans) for p, _ in examples])
        self.piece = np.array([b for b, (p, _) in enumerate(examples) for _ in p.segments])
        self.start = np.array([i for p, _ in examples for i, _ in p.segments])
        self.end = np.array([j + 1 for p, _ in examples for _, j in p.segments])
        self.features = np.array([f for p, _ in examples for f in p.features])
        self.length = int(self.sizes.max())
        self.by_end = self._groups(self.end)
        self.by_start = self._groups(self.start)
        labels = len(KINDS) + 1
        self.gold_moves = np.zeros((labels, labels))
        chosen = np.zeros((len(self.piece), len(KINDS)))
        offset = 0
        for p, gold in examples:
            index = {s: offset + n for n, s in enumerate(p.segments)}
            at, label = 0, 0
            for i, j, kind in [*gold, (len(p.spans), None, None)]:
                outside = i - at
                if outside:
                    self.gold_moves[label, 0] += 1
                    self.gold_moves[0, 0] += outside - 1
                    label = 0
                if kind is not None:
                    self.gold_moves[label, kind + 1] += 1
                    chosen[index[i, j], kind] = 1
                    at, label = j + 1, kind + 1
            offset += len(p.segments)
        self.gold = self.counts(chosen)

    def _groups(self, key: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each place: segments in order of their piece, where each piece begins, and the pieces."""
        out = []
        for place in range(self.length + 1):
            here = np.flatnonzero(key == place)
            pieces, first = np.unique(self.piece[here], return_index=True)
            out.append((here, first, pieces))
        return out

    def counts(self, chance: np.ndarray) -> np.ndarray:
        """Expected number of each feature by kind, given the chance of each segment and kind."""
        flat = self.features.ravel()
        return np.array([np.bincount(flat, np.repeat(chance[:, k], _WIDTH), len(_FEATURES)) for k in range(len(KINDS))])

    def expected(self, model: Model) -> tuple[float, np.ndarray, np.ndarray]:
        """Log-partition over all examples, expected feature counts, expected moves."""
        labels, low = len(KINDS) + 1, -1e30
        value = np.stack([w[self.features].sum(axis=1) for w in model.weights], axis=1)
        moves = model.moves
        alpha = np.full((len(self.sizes), self.length + 1, labels), low)
        alpha[:, 0, 0] = 0.0
        into = np.full((len(self.piece), labels - 1), low)
        sum_log = np.logaddexp.reduce
        for e in range(1, self.length + 1):
            alpha[:, e, 0] = sum_log(alpha[:, e - 1] + moves[:, 0], axis=1)
            here, first, pieces = self.by_end[e]
            if len(here):
                into[here] = sum_log(alpha[self.piece[here], self.start[here]][:, :, None] + moves[None, :, 1:], axis=1)
                alpha[pieces, e, 1:] = np.logaddexp.reduceat(into[here] + value[here], first, axis=0)
        beta = np.full_like(alpha, low)
        beta[np.arange(len(self.sizes)), self.sizes] = 0.0
        for s in range(self.length - 1, -1, -1):
            inside = self.sizes > s
            beta[inside, s] = moves[:, 0] + beta[inside, s + 1, 0][:, None]
            here, first, pieces = self.by_start[s]
            if len(here):
                onward = value[here] + beta[self.piece[here], self.end[here], 1:]
                each = sum_log(moves[None, :, 1:] + onward[:, None, :], axis=2)
                beta[pieces, s] = np.logaddexp(beta[pieces, s], np.logaddexp.reduceat(each, first, axis=0))
        total = beta[:, 0, 0]
        onward = value + beta[self.piece, self.end, 1:] - total[self.piece][:, None]
        chance = np.exp(np.minimum(into + onward, 0.0))
        steps = np.zeros_like(moves)
        pair = alpha[self.piece, self.start][:, :, None] + moves[None, :, 1:] + onward[:, None, :]
        steps[:, 1:] = np.exp(np.minimum(pair, 0.0)).sum(axis=0)
        for s in range(self.length):
            inside = self.sizes > s
            out = alpha[inside, s] + moves[:, 0] + (beta[inside, s + 1, 0] - total[inside])[:, None]
            steps[:, 0] += np.exp(np.minimum(out, 0.0)).sum(axis=0)
        return float(total.sum()), self.counts(chance), steps


def fit(examples: list[tuple[Piece, list[tuple[int, int, int]]]], steps: int = STEPS) -> Model:
    """Weights of greatest conditional likelihood with a ridge, by resilient gradient steps."""
    usable = [(p, gold) for p, gold in examples if p.segments and all((i, j) in set(p.segments) for i, j, _ in gold)]
    model = Model(np.zeros((len(KINDS), len(_FEATURES))), np.zeros((len(KINDS) + 1, len(KINDS) + 1)))
    if not usable:
        return model
    lattice = Lattice(usable)
    parts = [model.weights, model.moves]
    size = [np.full_like(p, 0.1) for p in parts]
    last = [np.zeros_like(p) for p in parts]
    for _ in range(steps):
        _, counts, moves = lattice.expected(model)
        slopes = [lattice.gold - counts - RIDGE * len(usable) / 100 * model.weights, lattice.gold_moves - moves - RIDGE * len(usable) / 100 * model.moves]
        for part, slope, step, before in zip(parts, slopes, size, last):
            agree = np.sign(slope) * np.sign(before)
            step[:] = np.clip(step * np.where(agree > 0, 1.2, np.where(agree < 0, 0.5, 1.0)), 1e-6, 1.0)
            slope = np.where(agree < 0, 0.0, slope)
            part += np.sign(slope) * step
            before[:] = slope
    return model


# --- Examples ------------------------------------------------------------------------------


def _gold(piece: Piece, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]] | None:
    """Spans (start, end, kind) of characters as tokens; None where they do not end with tokens."""
    first = {a: i for i, (a, _) in enumerate(piece.spans)}
    last = {b: i for i, (_, b) in enumerate(piece.spans)}
    out = [(first.get(a), last.get(b), kind) for a, b, kind in sorted(spans)]
    return None if any(i is None or j is None for i, j, _ in out) else out


def generated(n: int = GENERATED, seed: int = SEED) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Texts with spans, by rule: each kind in its usual forms, alone and side by side, and other numbers."""
    rng = random.Random(seed)

    def some(k: int) -> str:
        return "".join(rng.choice("0123456789") for _ in range(k))

    def word(low: int, high: int) -> str:
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(low, high)))

    def email() -> str:
        local = word(2, 8) + rng.choice(["", "." + word(2, 7), "_" + word(1, 4), some(2), "." + some(2)])
        return f"{local}@{word(2, 8)}{rng.choice(['', some(1)])}.{rng.choice(['', word(3, 8) + '.'])}{word(2, 3)}"

    def ip() -> str:
        return ".".join(str(rng.randint(0, 255)) for _ in range(4))

    def card() -> str:
        body = some(rng.choice([15, 15, 15, 17, 18]))
        number = next(body + d for d in "0123456789" if luhn(body + d))
        gap = rng.choice(["", "", " ", "-"])
        return gap.join(number[i : i + 4] for i in range(0, len(number), 4))

    def phone() -> str:
        code = rng.choice(["1", "44", "49", "351", "7"])
        form = rng.choice(["({}) {}-{}", "{} {} {}", "{}-{}-{}", "{}.{}.{}", "{}{}{}"])
        return "+" + code + rng.choice([" ", " ", "-", ""]) + form.format(some(3), some(3), some(4))

    def wrong_card() -> str:
        number = some(16)
        return number if not luhn(number) else wrong_card()

    makers = (email, ip, card, phone)
    others = (
        lambda: some(rng.randint(7, 12)), wrong_card, lambda: some(rng.randint(20, 30)),
        lambda: f"20{some(2)}-{some(2)}-{some(2)} {some(2)}", lambda: f"{some(2)}.{some(2)}.{some(4)}",
        lambda: ".".join(some(3) for _ in range(5)), lambda: f"{rng.randint(256, 999)}.{ip()}", lambda: "@" + word(3, 9),
        lambda: f"{word(2, 5)}@{word(3, 6)}", lambda: f"978-{some(1)}-{some(2)}-{some(6)}-{some(1)}",
        lambda: (word(2, 4) + some(4)) * 2, lambda: f"({some(3)}) {some(3)}-{some(4)}", lambda: f"+{some(3)}", lambda: "+" + some(20),
    )
    out = []
    for turn in range(n * len(makers)):
        text, spans = "", []
        for _ in range(rng.choice([1, 1, 2, 2, 3])):
            if rng.random() < 0.3:
                entity, kind = rng.choice(others)(), None
            else:
                kind = (turn + rng.randrange(2)) % len(makers)
                entity = makers[kind]()
            text += " " if text else ""
            if kind is not None:
                spans.append((len(text), len(text) + len(entity), kind))
            text += entity
        out.append((text, spans))
    return out


def _sample_places(docs: DataFrame, text_column: str) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Places of a bounded sample of texts whose base spans are undisputed, in order of their hash."""
    hashed = docs.select(F.col(text_column).alias("text")).where("text is not null").withColumn("h", F.xxhash64("text"))
    smallest = hashed.select("h").distinct().orderBy("h").limit(SAMPLE_TEXTS).agg(F.max("h")).first()[0]
    if smallest is None:
        return []
    texts = hashed.where(F.col("h") <= smallest).groupBy("h").agg(F.min("text").alias("text"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                by_kind, failed = base_spans(text)
                spans = sorted((a, b, k) for k, found in enumerate(by_kind) for a, b in found)
                taken = 0
                for low, high in places(text, [(a, b) for a, b, _ in spans], unknown_only=False):
                    mine = [(a - low, b - low, k) for a, b, k in spans if low <= a and b <= high]
                    cut_through = any(a < high and b > low and not (low <= a and b <= high) for a, b, _ in spans)
                    if cut_through or any(a < high and b > low for a, b in failed) or any(x[1] > y[0] for x, y in zip(mine, mine[1:])):
                        continue
                    if high - low <= SAMPLE_CHARS and taken < SAMPLE_PER_TEXT:
                        taken += 1
                        rows.append((text[low:high], ",".join(f"{a}:{b}:{k}" for a, b, k in mine)))
            yield pd.DataFrame(rows, columns=["place", "spans"])

    found = texts.select("text").mapInPandas(cut, "place string, spans string").distinct()
    rows = found.orderBy(F.xxhash64("place", "spans"), "place").limit(SAMPLE).collect()
    return [(r["place"], [tuple(map(int, s.split(":"))) for s in r["spans"].split(",") if s]) for r in rows]


def train(docs: DataFrame, text_column: str = "text") -> Model:
    sampled = _sample_places(docs, text_column)
    single = [(text[a:b], kind) for text, spans in sampled if len(spans) == 1 for a, b, kind in spans]
    side_by_side = [
        (x + " " + y, [(0, len(x), p), (len(x) + 1, len(x) + 1 + len(y), q)])
        for (x, p), (y, q) in zip(single, single[1:] + single[:1])
        if p != 0 and q != 0
    ]
    examples = []
    for text, spans in sampled + side_by_side[: SAMPLE // 2] + generated():
        piece = pieces_of(text)
        gold = _gold(piece, spans)
        if gold is not None:
            examples.append((piece, gold))
    return fit(examples)


# --- The scan ------------------------------------------------------------------------------


def added_spans(text: str, known: list[tuple[int, int]], model: Model) -> list[tuple[int, int, int]]:
    """Spans (start, end, kind) that the model finds between the known ones."""
    out, first = [], 0
    known = sorted(known)
    for low, high in places(text, known, unknown_only=True):
        while first < len(known) and known[first][1] <= low:
            first += 1
        edges = []
        for a, b in itertools.islice(known, first, None):
            if a >= high:
                break
            if b > low:
                edges.append((a, b))
        at, left = low, "edge"
        for a, b in [*edges, (high, high)]:
            if a > at:
                part = text[at:a]
                if "@" in part or len(digits_of(part)) >= MIN_DIGITS:
                    piece = pieces_of(part, left, "known" if a < high else "edge")
                    out += [(at + piece.spans[i][0], at + piece.spans[j][1], kind) for i, j, kind in model.best(piece)]
            at, left = max(at, b), "known"
    return out


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted((k, a, b) for a, b, k in spans))


OUTPUT = "doc_id string, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def find(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", model: Model | None = None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added), one row for each row of ``docs``.

    Counts and the digest cover base spans, ``spans`` also those of the model: ``kind:start:end`` in
    code points, by kind and start. A null text counts as empty, an empty one has no spans; repeated
    rows and ids are returned each; null ids stay null; an empty table gives no row. Texts are read
    whole and in time linear in their length. Other columns, whatever their names, are not looked at.
    """
    bound_batches(docs.sparkSession)
    model = model or train(docs, text_column)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                by_kind, _ = base_spans(text)
                spans = [(a, b, k) for k, found in enumerate(by_kind) for a, b in found]
                more = added_spans(text, [(a, b) for a, b, _ in spans], model) if any(c in text for c in "@+") or _CHUNK.search(text) else []
                digest = hashlib.sha256(_joined(spans).encode()).hexdigest()
                rows.append((*map(len, by_kind), digest, _joined(spans + more), len(more)))
            out = pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield out

    # Ids travel as strings, since pandas turns integers with nulls into floats.
    kind = dict(docs.dtypes)[id_column]
    rows = docs.select(F.col(id_column).cast("string").alias("doc_id"), F.coalesce(text_column, F.lit("")).alias("text"))
    return rows.mapInPandas(scan, OUTPUT).withColumn("doc_id", F.col("doc_id").cast(kind))


def op13_query(spark, sf_dir: str) -> DataFrame:
    return find(spark.read.parquet(f"{sf_dir}/documents.parquet"))
