import itertools
import random

from larder.llm import mincut

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="<p>no</p>";</script></head><body class="post">
<header><h1>Site name</h1></header><nav><ul><li><a href="/a">One</a><li><a href="/b">Two</a></ul></nav>
<div class="cookie-notice"><p>We use cookies, dear reader, and we like them.</p></div><!-- <p>ad</p> -->
<article><header><h1>Title &amp; more</h1></header><p>First   <b>bold</b> text,<br>and&nbsp;more &lt;here&gt;.
<p>Second <a href=x>linked</a> one&#33;<form><p>Your name</p><input></form>
<aside>Related things</aside><ul><li>item one<li>item two</ul>
<div id="comments"><article><p>A reader says hello, at length, in a full sentence.</p></article></div></article>
<div class="sidebar"><p>Buy now.</p></div><footer>&copy; me</footer></body></html>"""
WANT = "Title & more\nFirst bold text, and more <here>.\nSecond linked one!\nitem one\nitem two"


def test_article_without_the_rest():
    assert mincut.main_text(PAGE, mincut.Model()) == WANT


def test_defined_results_for_odd_pages():
    for page in (None, "", "<", "<p", "</p></div>", "<script>x", "<!-- x", "&nbsp;", "<a title='>", "<p a=\"x>y"):
        assert isinstance(mincut.main_text(page, mincut.Model()), str)
    assert mincut.main_text("<article>" + "<div>" * 3000 + "deep" + "<p>x " * 5000, mincut.Model()).startswith("deep\nx\nx")
    assert mincut.main_text("<article><p>a < b and 1<2</p><p title='a>b'>c</p></article>", mincut.Model()) == "a < b and 1<2\nc"


def test_minimum_cut_against_all_labellings():
    rng = random.Random(10)
    for _ in range(200):
        n = rng.randrange(1, 9)
        odds = [round(rng.uniform(-3, 3), 3) for _ in range(n)]
        edges = [(a, b, round(rng.uniform(0, 2), 3)) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.5]

        def cost(labels):
            return sum(max(0, o) if not x else max(0, -o) for o, x in zip(odds, labels)) + sum(
                w for a, b, w in edges if labels[a] != labels[b]
            )

        best = min(cost(x) for x in itertools.product((False, True), repeat=n))
        assert abs(cost(mincut.minimum_cut(odds, edges)) - best) < 1e-6


def test_extract_learns_and_keeps_rows(spark):
    words = "the quick brown fox, which jumped over a lazy dog, went home.".split()
    pages = []
    for i in range(40):
        body = "".join(f"<p>{' '.join(words[j % 7 :])} {i} {j}.</p>" for j in range(4))
        pages.append((i, f"u{i}", f"<nav><ul><li><a>Home</a></li><li><a>About</a></li></ul></nav><article>{body}</article><footer>c {i}</footer>", "clash"))
    plain = "<div><a>Home</a></div><div><a>News</a></div>" + "".join(f"<div>{' '.join(words)} And so on, {j}.</div>" for j in range(5)) + "<div><a>Top</a></div>"
    pages += [(100, None, plain, ""), (101, "u", None, ""), (None, "u", "", ""), (3, pages[3][1], pages[3][2], "")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, text string")
    model = mincut.train(df)
    assert any(model.weights)
    got = mincut.extract(df, model).collect()
    assert len(got) == len(pages)
    by = {r["page_id"]: r["text"] for r in got}
    assert by[101] == "" and by[None] == ""
    assert by[3].count("\n") == 3 and "Home" not in by[3]
    assert by[100].split("\n") == [f"{' '.join(words)} And so on, {j}." for j in range(5)]
    empty = df.limit(0)
    assert mincut.extract(empty, mincut.train(empty)).count() == 0


def test_valid_pages_that_leave_tags_out_or_name_their_layout():
    text = lambda page: mincut.main_text(page, mincut.Model())
    for raw in ("<svg class='i' viewBox='0 0 1 1'/>", "<math/>", "<svg><path/></svg>"):
        assert text(f"<article><p>One.</p>{raw}<p>Two.</p><svg></svg><p>Three.</p></article>") == "One.\nTwo.\nThree."
    assert text("<article><p>One.</p><svg><p>Two.</p></article>") == "One.\nTwo."
    for head in ("<html><head><title>x</title>", "<head><meta charset=u><title>x</title><style>p{}</style>\n<!-- y -->"):
        assert text(head + "<article><p>One.<p>Two.</article>") == "One.\nTwo."
        assert text(head + "</head><body><article>One.</article></body>") == "One."
        assert [b.text for b in mincut.blocks(head + "Bare <b>text</b><p>One.")] == ["Bare text", "One."]
        assert [b.text for b in mincut.blocks(head + "<p>One.")] == ["One."]
    for wrapper in ("div id='content' class='no-sidebar'", "main class='with-sidebar'", "div class='content hasSidebar'",
                    "div class='sidebar-right' id=content", "main class='sidebar-left'", "div class='entry overflow-hidden'"):
        assert text(f"<{wrapper}><p>One.</p></{wrapper.split()[0]}>") == "One.", wrapper
    for wrapper in ("div class='comment-body'", "div class='content hidden'", "nav id=main", "article class=comment", "div class='sidebar no-content'"):
        assert text(f"<{wrapper}><p>One.</p></{wrapper.split()[0]}>") == "", wrapper


def test_prose_is_kept_where_no_page_marks_its_parts(spark):
    prose = [f"Long ago, in town {i}, a baker and two sons of his sold bread to all who came by." for i in range(3)]
    menu = "<div><a href=/>Home</a></div><div><a href=/n>News of today</a></div>"
    plain = menu + "".join(f"<p>{x}</p>" for x in prose)
    tables = "<table><tr><td>" + menu + "</td><td>" + "<br><br></td><td>".join(prose) + "</td></tr></table>"
    only_content = "<article><p>" + "</p><p>".join(prose) + "</p></article>"
    only_off = "<nav><a>Home</a></nav><footer>me</footer>"
    for other in (None, only_content, only_off):
        rows = [(0, plain), (1, tables)] + ([(2, other)] if other else [])
        df = spark.createDataFrame(rows, "page_id long, html string")
        got = {r["page_id"]: r["text"] for r in mincut.extract(df, mincut.train(df)).collect()}
        assert got[0] == got[1] == "\n".join(prose)
        assert got.get(2, "") == ("\n".join(prose) if other == only_content else "")
