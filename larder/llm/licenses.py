"""Licence scans: TF-IDF cosine to templates, then inheritance from the nearest directory above.

Every line of every file, every run of comment lines, and the whole text of licence files (LICENSE,
COPYING and the like) is compared with licence templates by the cosine of sparse TF-IDF vectors.
Document frequencies are counted over all lines of all files, for the words of the templates; any
other word weighs as much as a word never seen, so it only lengthens a line's vector.

A file that states no licence takes that of the nearest directory at or above its own whose
licence file states one. Ancestors are listed for distinct directories only, and joined to the
licensed directories by path.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from larder.llm.batches import bound_batches
from larder.sources.staging import stage

THRESHOLD = 0.75
WORD = re.compile(r"[^\W_]+")
COMMENT = re.compile(r"\s*(?:#|//|/\*|\*|--|;|%|<!--)")
LICENSE_FILE = r"(?i)^(licen[cs]es?|copying|notice|unlicen[cs]e)([.-].*)?$"

# Licence identifiers, the names that statements use, and the wording of statements.
NAMES = {
    "Apache-2.0": ("the Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0"),
    "MIT": ("the MIT License", "MIT license", "MIT"),
    "BSD-2-Clause": ("the BSD 2-Clause License", "the Simplified BSD License", "BSD-2-Clause"),
    "BSD-3-Clause": ("the BSD 3-Clause License", "the New BSD License", "BSD-3-Clause"),
    "ISC": ("the ISC License", "ISC"),
    "GPL-2.0": ("the GNU General Public License, version 2", "GPL version 2", "GPL-2.0"),
    "GPL-3.0": ("the GNU General Public License, version 3", "GPL version 3", "GPL-3.0"),
    "LGPL-3.0": ("the GNU Lesser General Public License, version 3", "LGPL version 3", "LGPL-3.0"),
    "AGPL-3.0": ("the GNU Affero General Public License, version 3", "AGPL version 3", "AGPL-3.0"),
    "MPL-2.0": ("the Mozilla Public License, version 2.0", "MPL 2.0", "MPL-2.0"),
    "CC0-1.0": ("the Creative Commons Zero 1.0 Universal Public Domain Dedication", "CC0 1.0"),
    "CC-BY-4.0": ("the Creative Commons Attribution 4.0 International License", "CC BY 4.0"),
    "CC-BY-SA-4.0": ("the Creative Commons Attribution-ShareAlike 4.0 International License", "CC BY-SA 4.0"),
    "CC-BY-NC-4.0": ("the Creative Commons Attribution-NonCommercial 4.0 International License", "CC BY-NC 4.0"),
    "CC-BY-ND-4.0": ("the Creative Commons Attribution-NoDerivatives 4.0 International License", "CC BY-ND 4.0"),
    "Unlicense": ("the Unlicense", "Unlicense"),
}
STATEMENTS = (
    "{}",
    "Licensed under {}.",
    "Released under {}.",
    "Distributed under the terms of {}.",
    "This work is licensed under {}.",
    "SPDX-License-Identifier: {}",
)


def templates() -> list[tuple[str, str]]:
    """(licence, text) of every statement with every name."""
    return [(i, s.format(n)) for i, names in NAMES.items() for n in names for s in STATEMENTS]


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def units(text: str, whole: bool) -> Iterator[str]:
    """Lines, runs of comment lines, and the text itself if ``whole``."""
    run: list[str] = []
    for line in text.split("\n"):
        if COMMENT.match(line):
            run.append(line)
        else:
            if len(run) > 1:
                yield "\n".join(run)
            run = []
        yield line
    if len(run) > 1:
        yield "\n".join(run)
    if whole:
        yield text


class Matcher:
    """Cosine of a text to the nearest template, given how many lines hold each template word."""

    def __init__(self, texts: list[tuple[str, str]], lines: int, counts: dict[str, int]):
        self.unseen = math.log(1 + lines) + 1
        vocabulary = {w for _, t in texts for w in words(t)}
        self.idf = {w: math.log((1 + lines) / (1 + counts.get(w, 0))) + 1 for w in vocabulary}
        self.licenses = [i for i, _ in texts]
        self.postings: dict[str, list[tuple[int, float]]] = {}
        for n, (_, text) in enumerate(texts):
            weights = {w: tf * self.idf[w] for w, tf in Counter(words(text)).items()}
            norm = math.sqrt(sum(x * x for x in weights.values()))
            for w, x in weights.items():
                self.postings.setdefault(w, []).append((n, x / norm))

    def best(self, text: str, threshold: float = THRESHOLD) -> tuple[str, float] | None:
        """(licence, cosine) of the nearest template at or above ``threshold``; ties to the smaller name."""
        found = words(text)
        if not self.idf.keys() & set(found):
            return None
        known, other = 0.0, 0.0
        weights: dict[str, float] = {}
        for w, tf in Counter(found).items():
            idf = self.idf.get(w)
            if idf is None:
                other += (tf * self.unseen) ** 2
            else:
                weights[w] = tf * idf
                known += weights[w] ** 2
        norm = math.sqrt(known + other)
        if math.sqrt(known) < threshold * norm:
            return None  # no template can be nearer than the known words allow
        dots: dict[int, float] = {}
        for w, x in weights.items():
            for n, y in self.postings[w]:
                dots[n] = dots.get(n, 0.0) + x * y
        score, name = max((round(d / norm, 9), _Reversed(self.licenses[n])) for n, d in dots.items())
        return (name.text, score) if score >= threshold else None


class _Reversed:
    """Strings in descending order, so that max() takes the smaller one of a tie."""

    def __init__(self, text: str):
        self.text = text

    def __lt__(self, other):
        return self.text > other.text

    def __eq__(self, other):
        return self.text == other.text


def directory_of(path: Column) -> Column:
    """All before the last slash; empty at the top."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def line_counts(files: DataFrame, texts: list[tuple[str, str]]) -> tuple[int, dict[str, int]]:
    """Number of lines with a word in all files, and of those with each template word."""
    vocabulary = {w for _, t in texts for w in words(t)}

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, seen = 0, Counter()
        for batch in batches:
            for text in batch["text"]:
                for line in (text or "").lower().split("\n"):
                    found = set(WORD.findall(line))
                    if found:
                        n += 1
                        seen.update(vocabulary & found)
        seen[""] = n
        yield pd.DataFrame(list(seen.items()), columns=["word", "n"])

    # One row for each template word, whatever the input.
    rows = files.select("text").mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = {r["word"]: r["n"] for r in rows.collect()}
    return counts.pop("", 0), counts


def detect(files: DataFrame, texts: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``files`` (path, text, ...) without text, with license and score: what each states itself."""
    bound_batches(files.sparkSession)
    texts = texts if texts is not None else templates()
    matcher = Matcher(texts, *line_counts(files, texts))

    @F.pandas_udf("license string, score double")
    def stated(paths: pd.Series, contents: pd.Series) -> pd.DataFrame:
        is_license = re.compile(LICENSE_FILE)
        out = []
        for path, text in zip(paths, contents):
            whole = bool(is_license.match((path or "").rsplit("/", 1)[-1]))
            hits = [h for u in units(text or "", whole) if (h := matcher.best(u, threshold))]
            out.append(max(hits, key=lambda h: (h[1], _Reversed(h[0])), default=(None, None)))
        return pd.DataFrame(out, columns=["license", "score"])

    return files.withColumn("__own", stated("path", "text")).drop("text").select(
        *[c for c in files.columns if c != "text"], "__own.license", "__own.score"
    )


def inherit(stated: DataFrame) -> DataFrame:
    """``stated`` (path, license, score, ...) with origin and licensed_by; gaps filled from above.

    origin is own, inherited or null; licensed_by is the path of the licence file inherited from. Of
    several licence files in a directory the best score counts, then the smaller name and path. A
    null path has no directory and inherits nothing.
    """
    files = stated.withColumn("__dir", directory_of(F.col("path")))
    base = F.regexp_extract("path", r"[^/]*$", 0)
    licensed = (
        files.where(F.col("license").isNotNull() & base.rlike(LICENSE_FILE))
        .groupBy(F.col("__dir").alias("above"))
        .agg(F.min(F.struct((-F.col("score")).alias("s"), "license", "path")).alias("best"))
        .select("above", F.col("best.license").alias("l"), (-F.col("best.s")).alias("s"), F.col("best.path").alias("p"))
    )
    directories = files.where(F.col("__dir").isNotNull()).select("__dir").distinct()
    parts = F.split("__dir", "/")
    above = directories.select(
        "__dir",
        F.explode(
            F.when(F.col("__dir") == "", F.array(F.lit(""))).otherwise(
                F.transform(
                    F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/")
                )
            )
        ).alias("above"),
    )
    nearest = (
        above.join(licensed, "above")
        .groupBy("__dir")
        .agg(F.max(F.struct(F.length("above").alias("depth"), "l", "s", "p")).alias("n"))
        .select(F.col("__dir").alias("d"), "n.l", "n.s", "n.p")
    )
    own = F.col("license").isNotNull()
    return files.join(nearest, F.col("__dir") == F.col("d"), "left").select(
        *[c for c in stated.columns if c not in ("license", "score")],
        F.coalesce("license", "l").alias("license"),
        F.when(own, F.col("score")).otherwise(F.col("s")).alias("score"),
        F.when(own, "own").when(F.col("l").isNotNull(), "inherited").alias("origin"),
        F.when(~own, F.col("p")).alias("licensed_by"),
    )


def scan(files: DataFrame, texts: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Licence of every file: stated by itself or inherited. One row for each row of ``files``.

    A null or empty text states nothing; repeated rows stay; an empty table gives no row.
    """
    return inherit(stage(detect(files, texts, threshold), "licences"))


def document_files(docs: DataFrame) -> DataFrame:
    """Documents as files: source/language/ids in thousands/ids in fifties/id.txt.

    The first id of a folder stands for the licence file of that folder.
    """
    i = F.col("doc_id")
    folder = F.concat_ws("/", F.coalesce("source", F.lit("_")), F.coalesce("lang", F.lit("_")), F.floor(i / 1000).cast("string"))
    inner = F.concat_ws("/", folder, F.floor(i / 50).cast("string"))
    path = (
        F.when(i % 1000 == 0, F.concat_ws("/", folder, F.lit("LICENSE")))
        .when(i % 50 == 0, F.concat_ws("/", inner, F.lit("LICENSE")))
        .otherwise(F.concat_ws("/", inner, F.concat(i.cast("string"), F.lit(".txt"))))
    )
    return docs.select("doc_id", path.alias("path"), "text")


def op1_query(spark, sf_dir: str) -> DataFrame:
    return scan(document_files(spark.read.parquet(f"{sf_dir}/documents.parquet")))
