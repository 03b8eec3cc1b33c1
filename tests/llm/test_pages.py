"""Main text of pages: against the plain reading of a known template, and on templates of other kinds."""

import html
import re

import pytest

from millwright.llm import pages, queries

SF = "/root/testdata/sf0.01"


def plain(page):
    """The article element of the fixture's template, read with regular expressions."""
    body = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)[1]
    parts = [html.unescape(re.sub(r"</?b>", "", p)) for p in re.split(r"</?(?:p|h1|br)>", body)]
    return " ".join(filter(None, (" ".join(p.split()) for p in parts)))


def test_query_equals_plain_reading(spark):
    rows = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = queries.op4_html_extraction(spark, SF).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.url == rows[r.page_id].url
        assert r.text == plain(rows[r.page_id].html)
        assert r.n_chars == len(r.text)


def page(article, extra="", tail=""):
    return (f'<html><head><title>T</title><style>p{{a}}</style></head><body><div id="top-header">Site</div>'
            f'<div class="navbar"><ul><li><a href="/">Home<li>News</ul></div><div class="cookie-notice">We use cookies</div>'
            f'{article}<aside>Side</aside><form><p>Mail <input name=q> <button>Go</button></form>{extra}'
            f'<div class="comments"><article class="comment"><p>First!</p></article></div>'
            f'<div id="footer">&copy; x</div><script>if (a<b) x("</p>")</script>{tail}')


@pytest.mark.parametrize("wrap", ['<article>%s</article>', '<main><div class="x">%s</div></main>', '<div class="post-body">%s</div>'])
def test_other_templates(spark, wrap):
    bodies = [f"<h1>Head {i} &amp; co</h1><p>Some <i>in</i>line text{i}\n and   more<br>line &#233;<p>open <b>bold"
              f"<ul><li>one<li>two {i}</ul><div class='ad-slot'>Buy!</div><!-- no --><p>a < b &lt;tag&gt;</p>" for i in range(8)]
    rows = [(i, f"http://h.example/{i}", page(wrap % b), "x") for i, b in enumerate(bodies)]
    got = {r.page_id: r.text for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()}
    for i in range(8):
        assert got[i] == f"Head {i} & co Some inline text{i} and more line é open bold one two {i} a < b <tag>"


def test_edge_rows(spark):
    long = "<article>" + "<p>word &amp; " * 20_000
    rows = [(1, "http://a.example/1", None), (2, None, ""), (3, "nonsense", "<article>x</article>"), (None, "http://a.example/2", "just text"),
            (4, "http://a.example/3", "<nav>menu only</nav>"), (5, "http://a.example/3", "<p>cut off <b"), (6, "http://a.example/4", long),
            (6, "http://a.example/4", long), (7, "http://a.example/5", "<article>a&nbsp;b\x00</article"), (8, "http://A.example", "<<>>&bogus;")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = [(r.page_id, r.text) for r in pages.main_text(df).collect()]
    assert len(got) == len(rows)
    by = dict(got)
    assert by[1] == "" and by[2] == "" and by[3] == "x" and by[None] == "just text" and by[4] == "" and by[5] == "cut off"
    assert [t for i, t in got if i == 6] == [" ".join(["word &"] * 20_000)] * 2
    assert by[7].startswith("a b") and "&bogus;" in by[8]
    assert pages.main_text(df.limit(0)).count() == 0


def test_invalid_classes_are_left_out():
    found = [("html", 1, 0, False), ("html/body", 1, 5, False), ("html/body/div.a", 1, 0, False), ("html/body/div.b", 2, 0, False),
             ("html/body/div.a/p", 3, 50, False), ("html/body/div.b/p", 3, 50, False)]
    assert set(pages.build_template(found)) == {"html", "html/body", "html/body/div.a", "html/body/div.b"}
    assert pages.content_path([("html", 1, 0, False), ("html/article", 1, 10, False), ("html/article/p", 2, 90, False)]) == "html/article"


WRAPPERS = ["<div class='layout has-sidebar'>%s</div>", "<div class='content with-comments'>%s</div>", "<div id='main-menu-open'>%s</div>",
            "<form action=x>%s</form>", "<div class='sidebar-right'>%s</div>", "<article class='post has-comments'>%s</article>",
            "<div class='widget'><article>%s</article></div>"]
BODIES = ["<div class=content><h1>Head {i}</h1><div class=intro>Intro {i}</div><div class=text>{t}</div></div>",
          "<div class=body><h2>Head {i}</h2><div class=para>Intro {i}</div><div class=para>{t}</div></div>",
          "<article class=a><p>Head {i}</p><p>Intro {i}</p></article><article class=b><p>{t}</p></article>"]


def texts_of(spark, made):
    rows = [(i, f"http://h.example/{i}", p) for i, p in enumerate(made)]
    got = {r.page_id: r.text for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    return [got[i] for i in range(len(made))]


@pytest.mark.parametrize("wrap", WRAPPERS)
def test_wrappers_with_names_of_other_things(spark, wrap):
    said = [f"Story {i} " + f"word{i} " * 40 for i in range(8)]
    made = [f"<body><div class=navbar>Menu</div>{wrap % f'<p>{t}</p>'}<div class=comments>First!</div>" for t in said]
    assert texts_of(spark, made) == [t.strip() for t in said]


@pytest.mark.parametrize("body", BODIES)
def test_articles_of_several_blocks(spark, body):
    said = [f"Story {i} " + f"word{i} " * 40 for i in range(8)]
    made = [f"<body><div class=navbar>Menu</div><div class=top>My site</div>{body.format(i=i, t=t)}" for i, t in enumerate(said)]
    assert texts_of(spark, made) == [f"Head {i} Intro {i} {t.strip()}" for i, t in enumerate(said)]


@pytest.mark.parametrize("inside, want", [
    ("<p title=it's>first {i}<p title=it's>second {i}<p>third {i}", "first {i} second {i} third {i}"),
    ("<p data-id=menu>first {i}<p title='class=\"ad\"'>second {i}", "first {i} second {i}"),
    ("<p>so <math><mi>x</mi><mo>=</mo><mn>{i}</mn></math> holds<p>next", "so x={i} holds next"),
    ("<p>f <math><semantics><mi>y</mi><annotation>\\tex</annotation></semantics></math> is {i}", "f y is {i}"),
    ("<section data-u=/x/><p>kept {i}</section><p class=a/>and {i}", "kept {i} and {i}"),
    ("<p title=\"5 > {i}\" CLASS=a class=ad>one {i}<p>two", "one {i} two"),
    ("<p title=\"never closed>one {i}<p>two {i}", "one {i} two {i}"),
])
def test_attributes_by_the_standard(spark, inside, want):
    rows = [(i, f"http://h{i}.example/", f"<body><nav>menu</nav><article>{inside.replace('{i}', str(i))}</article><footer>end</footer>") for i in range(8)]
    got = {r.page_id: r.text for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: want.replace("{i}", str(i)) for i in range(8)}


@pytest.mark.parametrize("wrap", ["<article>%s</article>", "<div class=post-body>%s</div>"])
def test_names_inside_the_article(spark, wrap):
    """Only a whole name tells inside the article; nested inline boxes go whole."""
    said = [f"Story {i} " + f"word{i} " * 40 for i in range(8)]
    inner = ("<p>{t}</p><div class=related-work>work {i}</div><p id=alert-level>level {i}</p><p class=social-policy>policy {i}</p>"
             "<div class=related-posts>see {i}</div><p class='comment'>not me {i}</p><p>a<span class=ad>x<span>y {i}</span>z</span>b {i}</p>")
    made = [f"<body><div class=navbar>Menu</div>{wrap % inner.format(i=i, t=t)}<div class=footer>end</div>" for i, t in enumerate(said)]
    assert texts_of(spark, made) == [f"{t.strip()} work {i} level {i} policy {i} ab {i}" for i, t in enumerate(said)]


def test_constant_boxes_inside_the_article(spark):
    """A box that says the same on all pages is template, but not what copies of an article share, nor a heading."""
    story = lambda i: f"Story {i} " + f"word{i} " * 40
    inner = "<h2 class=series>The series</h2><p>{t}</p><div class=teaser><p>Read our book</p></div><p class=end>The end of {t}</p>"
    made = [f"<body><article>{inner.format(t=story(i))}</article>" for i in range(12)]
    assert texts_of(spark, made) == [f"The series {story(i).strip()} The end of {story(i).strip()}" for i in range(12)]
    copies = [f"<body><article>{inner.format(t=story(1))}</article>" for _ in range(12)]
    whole = f"The series {story(1).strip()} Read our book The end of {story(1).strip()}"
    assert texts_of(spark, copies) == [whole] * 12
    dated = [f"<body><article><p class=date>{i} May</p><div class=text><p>{story(1)}</p></div></article>" for i in range(12)]
    assert texts_of(spark, dated) == [f"{i} May {story(1).strip()}" for i in range(12)]
