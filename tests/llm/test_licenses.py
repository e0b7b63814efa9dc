import math
from collections import Counter

from larder.llm import licenses

PROSE = "the work of the public version under that general term is in the text and by the way under it\n" * 20
FILES = [
    ("LICENSE", "Released under the MIT License."),
    ("a/x.py", "# Licensed under the Apache License,\n# Version 2.0.\nimport os\n" + PROSE),
    ("a/y.py", PROSE),
    ("a/b/COPYING.txt", "GNU General Public License\nversion 3"),
    ("a/b/c/d/z.c", "int main;"),
    ("a/bb/z.c", None),
    ("e/LICENSE", PROSE),
    ("e/f.txt", ""),
    ("g/readme", PROSE + "Licensed under CC BY-NC 4.0.\n" + PROSE),
    (None, "Released under the MIT License."),
    (None, "nothing"),
    ("a/y.py", PROSE),
    ("long.txt", PROSE * 400 + "\nThis work is licensed under the GNU General Public License, version 3.\n"),
]


def test_scan_and_inheritance(spark):
    df = spark.createDataFrame([(*f, "clash") for f in FILES], "path string, text string, score string").drop("score")
    got = licenses.scan(df).collect()
    assert len(got) == len(FILES)
    by = {}
    for r in got:
        by.setdefault(r["path"], []).append((r["license"], r["origin"], r["licensed_by"]))
    assert by["LICENSE"] == [("MIT", "own", None)]
    assert by["a/x.py"] == [("Apache-2.0", "own", None)]
    assert by["a/y.py"] == [("MIT", "inherited", "LICENSE")] * 2
    assert by["a/b/COPYING.txt"] == [("GPL-3.0", "own", None)]
    assert by["a/b/c/d/z.c"] == [("GPL-3.0", "inherited", "a/b/COPYING.txt")]
    assert by["a/bb/z.c"] == [("MIT", "inherited", "LICENSE")]
    assert by["e/LICENSE"] == by["e/f.txt"] == [("MIT", "inherited", "LICENSE")]
    assert by["g/readme"] == [("CC-BY-NC-4.0", "own", None)]
    assert sorted(by[None], key=str) == sorted([("MIT", "own", None), (None, None, None)], key=str)
    assert by["long.txt"] == [("GPL-3.0", "own", None)]


def test_cosine_against_brute_force():
    texts = licenses.templates()
    counts = {"the": 900, "license": 30, "under": 200, "version": 80}
    matcher = licenses.Matcher(texts, 1000, counts)
    vocabulary = {w for _, t in texts for w in licenses.words(t)}

    def vector(text):
        idf = lambda w: math.log(1001 / (1 + (counts.get(w, 0) if w in vocabulary else 0))) + 1
        return {w: n * idf(w) for w, n in Counter(licenses.words(text)).items()}

    def cosine(a, b):
        return sum(x * b.get(w, 0) for w, x in a.items()) / math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))

    for text in ("Licensed under the MIT license, see file", "GPL version 2 or 3", "under the version", "MIT MIT MIT", "prose only", ""):
        scores = [(round(cosine(vector(text), vector(t)), 9), i) for i, t in texts] if licenses.words(text) else []
        top = max((s for s, _ in scores), default=0)
        want = (min(i for s, i in scores if s == top), top) if top >= 0.4 else None
        assert matcher.best(text, 0.4) == want


def test_counts_and_empty_table(spark):
    df = spark.createDataFrame([(f, t) for f, t in FILES], "path string, text string")
    lines, counts = licenses.line_counts(df, licenses.templates())
    every = [set(licenses.words(x)) for _, t in FILES for x in (t or "").split("\n")]
    assert lines == sum(map(bool, every))
    assert counts["license"] == sum("license" in x for x in every) and counts["the"] == sum("the" in x for x in every)
    assert licenses.scan(df.limit(0)).count() == 0


def test_documents_as_files(spark):
    df = spark.createDataFrame([(0, "t", "en", "s"), (50, "t", "en", "s"), (1051, "t", None, None), (None, "t", "en", "s")], "doc_id long, text string, lang string, source string")
    paths = [r["path"] for r in licenses.document_files(df).collect()]
    assert paths == ["s/en/0/LICENSE", "s/en/0/1/LICENSE", "_/_/1/21/1051.txt", "s/en"]
