"""Main text of HTML pages by minimum-cut labelling of text blocks.

A page is cut into text blocks (runs of text between block-level tags). A logistic model gives
each block its costs of being content and of being boilerplate; they become capacities from the
source and to the sink. Neighbouring blocks and blocks near each other in the tree of elements are
joined by smoothness edges, and a maximum flow finds the labelling of least total cost.

The model is trained here, without hand-labelled pages: blocks whose markup says what they are
(article or main against navigation, footers, adverts and so on) teach it what the text of each
kind looks like, on at most ``SAMPLE`` pages. Markup adds evidence of its own to the costs, and
scripts, styles, forms and the like are never content.
"""

from __future__ import annotations

import html as entities
import itertools
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from larder.llm.batches import bound_batches
from larder.sources.staging import stage

SAMPLE = 3_000
SMOOTH = 0.6
#: Evidence of markup, as log odds.
FOR_CONTENT, AGAINST_CONTENT = 6.0, 12.0
NEVER = 1e6

# Element names of the HTML standard, and words that sites use for class and id.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr br img".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg math".split())
#: What may stand in a head; any other element or text ends one whose end tag is left out.
METADATA = frozenset("base head link meta noframes noscript script style template title".split())
FOREIGN = frozenset(("svg", "math"))
UNSEEN = frozenset("head form button select option input object canvas audio video datalist dialog fieldset".split()) | RAW
OFF_TAGS = frozenset("nav footer aside header menu".split())
ON_TAGS = frozenset(("article", "main"))
ON_WORDS = frozenset("article main content post entry story body text".split())
OFF_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation "
    "menu breadcrumb breadcrumbs footer header masthead sidebar aside widget related recommended comment comments "
    "respond reply replies disqus discussion feedback cookie cookies consent gdpr notice notices notification alert "
    "popup modal newsletter subscribe subscription signup login share sharing social toolbar pagination pager "
    "copyright legal disclaimer skip hidden tags meta rating ratings review reviews".split()
)
#: Words that make the words after them in a name a matter of layout: "no-sidebar", "overflow-hidden".
MODIFIERS = frozenset("no not without with has have overflow".split())
ROLES_OFF = frozenset("navigation banner contentinfo complementary search alert dialog menu menubar form toolbar".split())
#: Elements that end an open p, and elements that end an open one of their own kind.
ENDS_P = frozenset(
    "address article aside blockquote center details dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hr main menu nav ol p pre section table ul".split()
)
ENDS_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCOPES = frozenset("ul ol dl table select article section div td th body main nav aside footer header".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|</?([a-zA-Z][^\s/>]*)((?:[^>\"'=]+|=\s*\"[^\"]*\"|=\s*'[^']*'|[\"'=])*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
WORDS_OF_NAME = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass(slots=True)
class Node:
    tag: str
    parent: "Node | None"
    depth: int
    on: bool = False
    off: bool = False
    unseen: bool = False


@dataclass(slots=True)
class Block:
    text: str
    node: Node
    linked: int = 0
    heading: bool = False


def _name_words(name: str) -> set[str]:
    """Words of one class or id up to the first layout modifier."""
    words = WORDS_OF_NAME.findall(CAMEL.sub(" ", name).lower())
    return set(itertools.takewhile(lambda w: w not in MODIFIERS, words))


def _open(tag: str, attributes: str, parent: Node) -> Node:
    node = Node(tag, parent, parent.depth + 1, parent.on, parent.off, parent.unseen)
    off, on = tag in OFF_TAGS, tag in ON_TAGS
    if tag == "header" and parent.on:
        off = False  # an article's own heading
    if tag in UNSEEN:
        node.unseen = True
    words: set[str] = set()
    # A name of ON words alone, as in id="content", holds against OFF words in the wrapper's other names.
    sure = tag == "main"
    if attributes and tag not in ("html", "body"):
        for name, *values in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), "".join(values)
            if name in ("class", "id"):
                for one in map(_name_words, value.split()):
                    words |= one
                    sure = sure or bool(one & ON_WORDS) and not one & OFF_WORDS
            elif name == "role":
                off = off or value.lower() in ROLES_OFF
                on = on or value.lower() in ("main", "article")
            elif name == "hidden" or name == "aria-hidden" and value == "true":
                node.unseen = True
            elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                node.unseen = True
    on = on or bool(words & ON_WORDS)
    off = off or "hidden" in words or bool(words & OFF_WORDS) and not (sure or tag in ON_TAGS and words & ON_WORDS)
    # What stands inside a boilerplate part stays so: a comment's own article is no main text.
    node.off = parent.off or off
    node.on = (parent.on or on) and not node.off
    return node


def blocks(page: str) -> list[Block]:
    """Text blocks in page order. Unclosed and stray tags are taken as browsers take them, roughly."""
    root = here = Node("", None, 0)
    out: list[Block] = []
    parts: list[str] = []
    at, linked, links, length = 0, 0, 0, len(page)

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text and not here.unseen:
                out.append(Block(text, here, linked, bool(re.fullmatch("h[1-6]", here.tag))))
            parts, linked = [], 0

    def leave_head() -> None:
        nonlocal here
        while here.tag == "head":
            here = here.parent

    while at < length:
        m = TOKEN.search(page, at)
        stop = m.start() if m else length
        if here.tag == "head" and page[at:stop].strip():
            leave_head()
        if stop > at and not here.unseen:
            parts.append(page[at:stop])
            if links:
                linked += stop - at
        if not m:
            break
        at = m.end()
        tag = m[1]
        if tag is None:
            continue  # comment, doctype
        tag = tag.lower()
        if page[m.start() + 1] == "/":
            if tag in INLINE:
                if tag == "a":
                    links = max(0, links - 1)
                continue
            flush()
            node = here
            while node.parent is not None and node.tag != tag:
                node = node.parent
            if node.parent is not None:
                here, links = node.parent, 0
            continue
        if tag not in METADATA:
            leave_head()
        if tag in INLINE:
            if tag == "br":
                parts.append(" ")
            elif tag == "a" and not here.unseen:
                links += 1
            continue
        flush()
        links = 0
        if tag in ENDS_P:
            node = here
            while node.parent is not None and node.tag != "p" and node.tag not in SCOPES:
                node = node.parent
            if node.tag == "p":
                here = node.parent
        if ends := ENDS_SAME.get(tag):
            node = here
            while node.parent is not None and node.tag not in ends and node.tag not in SCOPES - ends:
                node = node.parent
            if node.tag in ends:
                here = node.parent
                if tag == "tr" and here.tag == "tr":
                    here = here.parent
        if tag in VOID:
            continue
        if tag == "body":  # a head that was never closed ends here
            node = here
            while node.parent is not None and node.tag != "html":
                node = node.parent
            here = node
        opened = _open(tag, m[2], here)
        if tag in RAW:
            if tag in FOREIGN and m[0].endswith("/>"):
                continue
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            if tag in FOREIGN and not end:
                continue
            at = end.end() if end else length
            continue
        here = opened
    flush()
    return out


FEATURES = ("bias", "log_words", "link_share", "ends_sentence", "commas", "capitals", "heading", "short", "digits_symbols")
#: Weights before any page is seen: long text and whole sentences speak for content, links against it. A
#: sentence of ten words is content, a label of a few words is not. The fit is drawn to these, and they
#: stand alone where no blocks of both kinds are marked.
PRIOR = (-3.0, 1.0, -3.0, 1.5, 0.0, 0.0, 1.0, 0.0, 0.0)
_END = re.compile(r"[.!?…:;\"'»)\]]\W*$")


def text_features(block: Block) -> list[float]:
    """What the text looks like, apart from markup names."""
    text = block.text
    words = text.split()
    n = len(words)
    letters = sum(map(str.isalpha, text)) or 1
    return [
        1.0,
        float(np.log1p(n)),
        min(1.0, block.linked / max(1, len(text))),
        1.0 if _END.search(text) else 0.0,
        min(1.0, text.count(",") / n * 5),
        sum(w[:1].isupper() for w in words) / n,
        1.0 if block.heading else 0.0,
        1.0 if n <= 3 else 0.0,
        min(1.0, (len(text.replace(" ", "")) - letters) / letters),
    ]


@dataclass
class Model:
    """Logistic weights of ``FEATURES``: log odds of content."""

    weights: list[float] = field(default_factory=lambda: [0.0] * len(FEATURES))

    def odds(self, block: Block) -> float:
        z = sum(w * x for w, x in zip(self.weights, text_features(block)))
        z = max(-4.0, min(4.0, z))
        if block.node.off:
            return z - AGAINST_CONTENT
        return z + FOR_CONTENT if block.node.on else z


def _edges(found: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness edges: neighbours, weighted by their distance in the tree, and the last block
    before with the same parent element."""
    out = []
    last: dict[int, int] = {}
    for i, b in enumerate(found):
        if i:
            a, c, steps = found[i - 1].node, b.node, 0
            while a is not c:
                if a.depth >= c.depth:
                    a = a.parent
                else:
                    c = c.parent
                steps += 1
            out.append((i - 1, i, SMOOTH * 2 / (1 + steps)))
        parent = id(b.node.parent or b.node)
        if last.get(parent, i - 1) != i - 1:
            out.append((last[parent], i, SMOOTH / 2))
        last[parent] = i
    return out


def minimum_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """True for nodes on the source side of a minimum cut.

    Positive odds are capacities from the source, negative ones to the sink, edges have their
    weight both ways. Augmenting paths run by breadth-first levels (Dinic); what a node has from
    the source and owes to the sink has been settled already, so only smoothness edges carry flow.
    """
    n = len(odds)
    if n == 0 or min(odds) >= 0:
        return [o > 0 for o in odds] if n else []
    eps = 1e-9
    give = [max(0.0, o) for o in odds]
    take = [max(0.0, -o) for o in odds]
    to: list[int] = []
    cap: list[float] = []
    out: list[list[int]] = [[] for _ in range(n)]
    for a, b, w in edges:
        out[a].append(len(to))
        out[b].append(len(to) + 1)
        to += [b, a]
        cap += [w, w]
    while True:
        level = [-1] * n
        queue = deque(i for i in range(n) if give[i] > eps)
        for i in queue:
            level[i] = 0
        reached = False
        while queue:
            u = queue.popleft()
            if take[u] > eps:
                reached = True
            for e in out[u]:
                v = to[e]
                if cap[e] > eps and level[v] < 0:
                    level[v] = level[u] + 1
                    queue.append(v)
        if not reached:
            return [x >= 0 for x in level]
        nxt = [0] * n
        for s in range(n):
            while give[s] > eps:
                path, u = [], s
                while take[u] <= eps:
                    while nxt[u] < len(out[u]):
                        e = out[u][nxt[u]]
                        if cap[e] > eps and level[to[e]] == level[u] + 1:
                            break
                        nxt[u] += 1
                    if nxt[u] < len(out[u]):
                        e = out[u][nxt[u]]
                        path.append(e)
                        u = to[e]
                    elif path:
                        u = to[path.pop() ^ 1]
                        nxt[u] += 1
                    else:
                        break
                if take[u] <= eps:
                    break
                flow = min([give[s], take[u], *(cap[e] for e in path)])
                give[s] -= flow
                take[u] -= flow
                for e in path:
                    cap[e] -= flow
                    cap[e ^ 1] += flow


def main_text(page: str | None, model: Model) -> str:
    """Content blocks joined by newlines; empty for null, for empty pages and where none is content."""
    found = blocks(page or "")
    keep = minimum_cut([model.odds(b) for b in found], _edges(found))
    return "\n".join(b.text for b, k in zip(found, keep) if k)


def train(pages: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on the pages of smallest hash of page_id; without marked blocks of both kinds weights are ``PRIOR``."""
    bound_batches(pages.sparkSession)
    chosen = pages.select("page_id").orderBy(F.xxhash64("page_id"), "page_id").limit(sample).distinct()
    picked = pages.select("page_id", "html").join(F.broadcast(chosen), "page_id")  # at most `sample` ids

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = [
                (1 if b.node.on else 0, text_features(b))
                for page in batch["html"]
                for b in blocks(page or "")
                if b.node.on != b.node.off
            ]
            yield pd.DataFrame(got, columns=["y", "x"])

    marked = stage(picked.mapInPandas(rows, "y int, x array<double>"), "page-blocks")
    sums = dict(marked.groupBy("y").agg(F.count(F.lit(1))).collect())
    if len(sums) < 2:
        return Model(list(PRIOR))
    prior = np.array(PRIOR)
    w = prior
    share = {y: 0.5 / n for y, n in sums.items()}

    def gradients(batches: Iterator[pd.DataFrame], w: list[float]) -> Iterator[pd.DataFrame]:
        weight = np.array(w)
        g, h = np.zeros(len(w)), np.zeros((len(w), len(w)))
        for batch in batches:
            if len(batch):
                x = np.stack(batch["x"].to_numpy())
                y = batch["y"].to_numpy()
                p = 1 / (1 + np.exp(-x @ weight))
                c = np.where(y == 1, share[1], share[0])
                g += x.T @ (c * (y - p))
                h += (x * (c * p * (1 - p))[:, None]).T @ x
        yield pd.DataFrame({"g": [g.tolist()], "h": [h.ravel().tolist()]})

    for _ in range(6):  # Newton steps; both kinds weigh the same
        now = w.tolist()
        parts = marked.mapInPandas(lambda b: gradients(b, now), "g array<double>, h array<double>").toPandas()  # noqa: B023
        g = np.sum(np.stack(parts["g"].to_numpy()), axis=0) - 1e-2 * (w - prior)
        h = np.sum(np.stack(parts["h"].to_numpy()), axis=0).reshape(len(w), len(w)) + 1e-2 * np.eye(len(w))
        w = w + np.linalg.solve(h, g)
    return Model([round(float(x), 6) for x in w])


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """``pages`` with ``text`` added (replacing a column of that name): one row for each row."""

    bound_batches(pages.sparkSession)

    @F.pandas_udf("string")
    def text_of(htmls: pd.Series) -> pd.Series:
        return pd.Series([main_text(x, model) for x in htmls], dtype=object)

    return pages.withColumn("text", text_of("html"))


def op7_query(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages, train(pages)).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars")
    )
