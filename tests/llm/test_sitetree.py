"""Extraction from pages whose main text is known."""

import html as markup
import math
import random
import re
import time
from html.parser import HTMLParser

import pyarrow as pa
import pytest

from gridloom.llm import sitetree


def test_pages_of_the_tables(spark, sf_dir):
    """The article of these pages, read off by a plain pattern, is the main text."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r for r in sitetree.op3_html_extraction(spark, sf_dir).collect()}
    assert len(got) == pages.count()
    for page in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", page.html, re.S)[1]
        blocks = [re.sub(r"<[^<>]*>", " ", b) for b in re.split(r"</?(?:p|h1)>", inner)]
        want = [" ".join(markup.unescape(b).split()) for b in blocks]
        assert got[page.page_id].text == "\n\n".join(b for b in want if b)
        assert got[page.page_id].n_chars == len(got[page.page_id].text) and got[page.page_id].url == page.url


def text(page, low=frozenset()):
    return sitetree.main_text(page, "h", low)


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("", ""),
        ("plain &amp; simple\n text", "plain & simple text"),
        ("<p>a<p>b<br>c<p>d", "a\n\nb c\n\nd"),
        ("<header>x</header><main><header><h1>T</h1></header><p>b</p><footer>f</footer></main>", "T\n\nb"),
        ("<div class='cookie-notice'>x</div><div id=mainMenu>m</div><p>a", "a"),
        ("<div>a<div class=sideBar>s<p>t</p></div>b</div>", "a\n\nb"),
        ("<article><p>a</p><section class=comments><p>c</p></section></article><p>out</p>", "a"),
        ("<script>if (a<b) x='</p>';</script><style>p{}</style><p>a<!-- c > d --></p>", "a"),
        ("<p>a <b>b</b><i>c</i> d</p><ul><li>x<li>y</ul>", "a bc d\n\nx\n\ny"),
        ("<p>x &lt;b&gt; &#233;&eacute;&nbsp; y</p>", "x <b> éé y"),
        ("<form>f<p>g</p></form><p hidden>h</p><p style='display: none'>i</p><p>a", "a"),
        ("<article><b>un<p>closed</article>", "un\n\nclosed"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a\n\nb\n\nc"),
        ("<p title=\"a > b\">t</p><broken <p>u", "t\n\nu"),
    ],
)
def test_blocks(page, want):
    assert text(page) == want


def site(seed, n=40):
    """Pages without telling names: what repeats on the host is the template."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(5))
    rows, want = [], {}
    notes = [" ".join(word() for _ in range(6)) for _ in range(3)]
    for i in range(n):
        paragraphs = [" ".join(word() for _ in range(20)) for _ in range(draw.randrange(1, 6))]
        body = "".join(f"<p class=c1>{p}</p>" for p in paragraphs)
        rows.append((i, f"https://u@s{seed}.example.org:80/{i}", f"<body><div class=x1>Home <a>About</a></div><div class=x2>{draw.choice(notes)}</div><div class=x3>{body}</div><div class=x4>All rights</div>"))
        want[i] = "\n\n".join(paragraphs)
    return rows, want


def test_templates_are_found_per_host(spark):
    rows, want = site(1)
    rows.append((500, "http://alone.example.org/", rows[0][2]))  # one page is no template
    rows += [(600 + i, "http://copies.example.org/%d" % i, rows[1][2]) for i in range(30)]  # nor are copies
    rows += [(None, None, None), (700, "no url", ""), (700, "no url", "")]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, node int")
    got = sitetree.extract(pages)
    texts = {r.page_id: r.text for r in got.collect()}
    assert {i: texts[i] for i in want} == want
    assert texts[500].startswith("Home About") and texts[600].startswith("Home About")
    assert texts[None] == texts[700] == "" and got.count() == len(rows)
    joined = sitetree.extract(pages, most_broadcast=0)
    assert sorted(joined.collect(), key=str) == sorted(got.collect(), key=str)
    assert sitetree.extract(pages.limit(0)).collect() == []


def test_long_page():
    page = "<article>" + "<p>word &amp; word</p>" * 50_000
    assert text(page) == "\n\n".join(["word & word"] * 50_000)


def texts_of(spark, pages):
    """Extracted texts of pages of one host, in their order."""
    rows = [(i, f"http://one.example.org/{i}", page) for i, page in enumerate(pages)]
    got = sitetree.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return [r.text for r in sorted(got, key=lambda r: r.page_id)]


@pytest.mark.parametrize("copies", [0, 13])
@pytest.mark.parametrize("around", ["article", "div"])
def test_wrappers_keep_important_text(spark, around, copies):
    """A fixed layout around the text does not take it along, a third of near copies either."""
    pages, want = [], []
    for i in range(40):
        own = [f"paragraph {j} of page {0 if i < copies else i}, told once" for j in range(3)]
        own[-1] += f" {i}"
        body = "".join(f"<p>{p}</p>" for p in own)
        pages.append(
            f"<body><div class=wrapper><div class=x1>Home</div><div class=x2>All rights</div><div class=x3>note {i % 3}</div>"
            f"<{around} class=x4>{body}</{around}></div></body>"
        )
        want.append("\n\n".join(own))
    assert texts_of(spark, pages) == want


def test_articles_are_kept_where_near_copies_dominate(spark):
    """99 of 100 pages are near copies: their articles stay, and that of the other page."""
    pages = [f"<div class=d>day {i}</div><article><h1>Same title</h1><p>the same words on all pages</p></article>" for i in range(99)]
    pages.append("<div class=d>day 1</div><article><h1>Same title</h1><p>one of its own</p></article>")
    assert texts_of(spark, pages) == ["Same title\n\nthe same words on all pages"] * 99 + ["Same title\n\none of its own"]


def test_near_copies_without_article_count_once(spark):
    body = " ".join(f"w{j}" for j in range(300))
    pages = [f"<div class=a><h1>Same title</h1><p>{body}</p></div><div class=d>{i}</div>" for i in range(60)]
    other = "<div class=a><h1>Same title</h1><p>one of its own</p></div><div class=d>1</div>"
    got = texts_of(spark, [*pages, other])
    assert got[-1].startswith("Same title\n\none of its own") and all(body in text for text in got[:-1])


@pytest.mark.parametrize("n", [40, 1500])
def test_entropies_do_not_fall_with_pages(spark, n):
    """A list that all pages share goes and one of thirty openings stays, however many pages there are."""
    menu = "".join(f"<li>entry {j}</li>" for j in range(30))
    rows = [f"<ul>{menu}</ul><div class=o>opening {i % 30}</div><div class=t>own text of page {i}</div>" for i in range(n)]
    assert texts_of(spark, rows) == [f"opening {i % 30}\n\nown text of page {i}" for i in range(n)]


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<article><section id='related-work'><h2 id=search-and-navigation>R</h2><p>a</p></section></article>", "R\n\na"),
        ("<article><div id=login class='reply-guide'>a</div><section id='notification-settings'>b</section></article>", "a\n\nb"),
        ("<article><p>a</p><div class='share-buttons'>s</div><div class='x Comments'>c</div><div class=ad>d</div></article>", "a"),
        ("<h2 id='social-history'>a</h2><section id='related'>b</section><div id=related>c</div>", "a\n\nb"),
        ("<p>let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be</p>", "let x=1 be"),
        ("<p>a</p><svg><path d='m'><p>b</p>", "a\n\nb"),
        ("<title>no end<p>a</p><object><p>b</p>", "no end\n\na\n\nb"),
        ("<p>a</p><script>x = 1; <p>b</p>", "a"),
    ],
)
def test_names_and_raw_elements(page, want):
    assert text(page) == want


def test_teasers_are_not_the_only_text(spark):
    """Cards declared as articles do not take the place of a text in plain elements."""
    own = ["one long paragraph of page %d with a dozen words in all of it", "a second one, page %d"]
    pages, want = [], []
    for i in range(12):
        body = "".join(f"<p>{p % i}</p>" for p in own)
        cards = "".join(f"<article><h3>card {i} {j}</h3></article>" for j in range(3))
        pages.append(f"<div class=a>Home</div><div class=b>{body}</div><div class=c>{cards}</div>")
        want.append("\n\n".join([p % i for p in own] + [f"card {i} {j}" for j in range(3)]))
    assert texts_of(spark, pages) == want


def test_several_articles_with_most_of_the_text():
    many = "<p>out</p><article><p>first of two</p></article><article><p>second of two</p></article>"
    assert text(many) == "first of two\n\nsecond of two"
    assert text("<p>out, and long</p><main><article>a</article><article>b</article></main>") == "a\n\nb"


LONG = 1_000_000
BROKEN = {
    "open tags": "<b>" + "<i " * (LONG // 3),
    "open tags with an end": "<b>" + "<i " * (LONG // 3) + "\">x",
    "open quotes": "<" + 'a"' * (LONG // 2),
    "quoted ends": "<a '>' " * (LONG // 7),
    "names without end": "<a" * (LONG // 2),
    "nested": "<div>x" * 100_000 + "<p>y" * 50_000,
    "nested, closed by others": "<div>x" * 100_000 + "</section></span>" * 50_000,
    "nested inline": "<p>" + "<b>" * 100_000 + "<h1>x</h1>" * 50_000 + "</i>" * 50_000,
    "articles in articles": "<article>x<div>" * 60_000,
    "comments": "<!--" * (LONG // 4),
    "declarations": "<!x" * (LONG // 3),
    "scripts without end": "<p>a</p><svg>" * 60_000 + "<script>" * 10_000,
    "references": "&amp;&#x41;&" * (LONG // 12),
    "attributes": "<div " + "a='b' " * (LONG // 6) + ">text",
    "blank attributes": "<div a" + " " * LONG + ">text",
    "rows and cells": "<table>" + "<tr><td>1<td>2" * 60_000,
}


@pytest.mark.parametrize("name", sorted(BROKEN))
def test_long_broken_pages_end(name):
    began = time.perf_counter()
    sitetree.main_text(BROKEN[name], "h", {1})
    list(sitetree._features(iter([pa.RecordBatch.from_pydict({"url": ["http://h/"], "html": [BROKEN[name]]})])))
    assert time.perf_counter() - began < 15  # two parses, on a slow machine


def test_unclosed_quotes_end_at_the_next_end():
    assert sitetree.main_text('<p>a</p><p title="x>b</p><p>c</p>', "h", set()) == "a\n\nb\n\nc"
    assert sitetree.main_text("<p title='x>y'>b</p>", "h", set()) == "b"


class Twin(HTMLParser):
    """Blocks with the path around them, and each path's children, of a well-formed page."""

    def __init__(self, page):
        super().__init__()
        self.path, self.blocks, self.shapes = (), [], {(): []}
        self.feed(page)

    def handle_starttag(self, tag, attrs):
        style = ".".join([tag, *sorted((dict(attrs).get("class") or "").split())])
        children = self.shapes.setdefault(self.path, [])
        if children[-1:] != [style]:
            children.append(style)
        self.path += (style,)
        self.shapes.setdefault(self.path, [])

    def handle_endtag(self, tag):
        self.path = self.path[:-1]

    def handle_data(self, data):
        if data.strip():
            self.blocks.append((self.path, " ".join(data.split())))


def twin_texts(pages):
    """Main texts by the definitions: trees merged, entropies reckoned page by page, low branches left out."""
    trees = [Twin(page) for page in pages]
    seen, shapes, contents = {}, {}, {}
    for number, tree in enumerate(trees):
        for path, text in tree.blocks:
            seen.setdefault(path, set()).add(number)
            shapes.setdefault(path, {}).setdefault(tuple(tree.shapes[path]), set()).add(number)
            contents.setdefault(path, {}).setdefault(text, set()).add(number)

    def entropy(features, pages):
        if pages == 1:
            return 1.0
        sizes = [len(own) for own in features.values()]
        mean = sum(n * math.log(pages / n) for n in sizes) / sum(sizes)
        return min(1.0, mean / math.log(min(pages, sitetree.FEW_PAGES)))

    low = set()
    for path, pages_of in seen.items():
        presentation, content = (entropy(x[path], len(pages_of)) for x in (shapes, contents))
        inner = any(style for shape in shapes[path] for style in shape)
        importance = max((presentation + content) / 2, content) if inner else content
        if len(pages_of) >= sitetree.MIN_PAGES and importance < sitetree.LOW:
            low.add(path)
    return ["\n\n".join(text for path, text in tree.blocks if path not in low) for tree in trees], low


@pytest.mark.parametrize("seed", range(3))
def test_the_style_tree_decides_where_nothing_is_declared(spark, seed):
    """No article and no telling name: the tree alone parts template from text, as a plain version does."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(6))
    notes = [" ".join(word() for _ in range(6)) for _ in range(3)]

    def page(n):
        own = "".join(f"<p>{' '.join(word() for _ in range(20 + n % 3))}</p>" for _ in range(draw.randrange(1, 5)))
        odd = f"<div class='q{draw.randrange(9)}'><p>{word()} {word()}</p></div>" if draw.random() < 0.4 else ""
        return (
            f"<html><body><div class='a'><p>{notes[0]}</p><p>{draw.choice(notes)}</p></div>"
            f"<div class='b'><div class='c'><h1>{word()} {word()}</h1>{own}</div><div class='d'>{draw.choice(notes)}</div></div>{odd}"
            f"<div class='e'><ul><li>{notes[1]}</li><li>{notes[2]}</li></ul>{notes[0]}</div></body></html>"
        )

    pages = [page(n) for n in range(60)]
    rows = [(n, "http://one.example/x", text) for n, text in enumerate(pages)]
    got = sitetree.extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    found = {r.page_id: r.text for r in got.collect()}
    want, low = twin_texts(pages)
    assert [found[n] for n in range(len(pages))] == want
    assert len(low) >= 3  # branches that only the tree removes
    assert all(note not in text for note in notes for text in want) and all(text.count("\n\n") for text in want)
