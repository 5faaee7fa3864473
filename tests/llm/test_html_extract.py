import random

import pytest

from strata.llm.html_extract import Page, _marked, _rebuilt, choose, extract, features, fit_extractor
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet(f"{FOLDER}/pages.parquet")


@pytest.fixture(scope="module")
def trees(pages):
    return fit_extractor(pages)


def test_articles_are_extracted_exactly(pages, trees):
    found = {r["page_id"]: r["_text"] for r in extract(pages, trees, ["page_id", "url"]).collect()}
    rows = pages.collect()
    assert len(found) == len(rows)
    for r in rows:
        assert found[r["page_id"]] == brute.article(r["html"])


def test_other_dress(pages, trees):
    pick = random.Random(123)
    words = "some words of other parts that no article has".split()

    def say(n):
        return " ".join(pick.choice(words) for _ in range(n))

    exact, rows = 0, pages.limit(60).collect()
    for r in rows:
        page = Page(r["html"])
        texts = [(page.tags[x[0]], x[1]) for x, main in zip(page.runs, _marked(page)) if main]
        new = Page(_rebuilt(texts, say, pick))
        main = [x[1] for x in new.runs if "data-main" in new.attributes[x[0]]]
        exact += choose(new, trees.logits(features(new))) == main
    assert exact >= 0.9 * len(rows)


def test_odd_pages(spark, trees):
    html = [
        None, "", "   ", "no tags &amp; more", "<p>a<br>b&nbsp;&lt;c", "<" * 5000, "<a \"" * 3000, "<div>" * 2000 + "deep",
        "<script>var a = '<p>x</p>'</script><!-- <p>y</p> --><style>p{}</style>", "<p>" + "word " * 100_000 + "</p>",
        "<ul><li>a<li>b</ul>text</div></p>", "<TITLE>t</TITLE><P>Loud",
    ]
    rows = spark.createDataFrame([(i, h, "u", 1) for i, h in enumerate(html)], "page_id int, html string, _text string, n int")
    found = {r["page_id"]: r["_text"] for r in extract(rows, None, ["page_id", "n"]).collect()}
    assert found[0] == found[1] == found[2] == found[8] == ""
    assert found[3] == "no tags & more" and found[4] == "a b <c" and found[7] == "deep"
    assert found[10] == "a\nb\ntext" and found[11] == "Loud"
    assert extract(rows, trees, ["page_id"]).count() == len(html)
    assert extract(rows.where("1 = 0"), trees, ["page_id"]).collect() == []
    assert fit_extractor(rows) is None


def test_choices_do_not_contradict(trees):
    page = Page("<article><p>one</p><div class=ad><p>two</p><p>three</p></div><p>four</p></article>")
    names = dict(zip(page.tags, range(len(page.tags))))
    logits = [0.0] * len(page.tags)
    logits[names["article"]], logits[names["div"]] = 2.0, -3.0
    import numpy as np

    assert choose(page, np.array(logits) + 0.1) == ["one", "four"]


def runs(source):
    return [r[1] for r in Page(source).runs]


@pytest.mark.parametrize(
    "tag",
    [
        f'<img src="data:image/png;base64,{"A" * 3000}">',
        f"<div data-json='{'{}>' * 3000}'></div>",
        f"<div data-list={'a,b' * 3000}></div>",
        f"<div {'x=1 ' * 3000}></div>",
        f"<?xml {'x' * 3000}?>",
        f"<!doctype {'x' * 3000}>",
        "<div title=it's></div>",
    ],
)
def test_tags_of_any_length_are_no_text(tag):
    source = f"<article><p>before</p>{tag}<p>after, isn't it</p></article>"
    page = Page(source)
    assert [(r[1], page.tags[page.parents[r[0]]]) for r in page.runs] == [
        ("before", "article"),
        ("after, isn't it", "article"),
    ]


@pytest.mark.parametrize(
    "source, texts",
    [
        ("<html><head><title>t</title><meta name=a><body><p>one</p><p>two</p></body></html>", ["one", "two"]),
        ("<head><title>t</title><style>p{}</style><p>one</p>", ["one"]),
        ("<head><script>x</script></head><p>one</p>", ["one"]),
        ('<p>one</p><svg class="x"/><p>two</p>', ["one", "two"]),
        ("<p>one</p><math/><p>two</p>", ["one", "two"]),
        ("<p>one</p><svg><style/><text>no</text><svg>no</svg>no</svg><p>two</p>", ["one", "two"]),
        ("<p>one</p><svg><p>two</p><svg>no</svg><p>three</p>", ["one", "two", "three"]),
        *[
            (f"<p>one</p><{tag}><p>two</p>", ["one", "two"])
            for tag in ("select", "object", "canvas", "noscript", "template", "iframe")
        ],
        *[
            (f"<p>one</p><{tag} data-x='>'>no</{tag} ><p>two</p>", ["one", "two"])
            for tag in ("select", "object", "script", "textarea", "title", "iframe")
        ],
        *[(f"<p>one</p><{tag}>no<p>no</p>", ["one"]) for tag in ("script", "style", "textarea", "title")],
    ],
)
def test_skipped_elements_end(source, texts):
    assert runs(source) == texts


def text_of(spark, trees, page):
    rows = spark.createDataFrame([(1, page)], "page_id int, html string")
    return extract(rows, trees, ["page_id"]).first()["_text"]


FRAME = "<html><body><nav><ul><li><a href=#>Home</a></li><li><a href=#>News</a></li></ul></nav>{}<footer><p>Copyright words here</p></footer></body></html>"


@pytest.mark.parametrize(
    "article, text",
    [
        ("<h1>Short</h1><p>One line only.</p>", "Short\nOne line only."),
        ("<h1>A title of some words</h1><p>A first block of text, long enough to be one.</p>"
         "<pre>some code</pre><ul><li>first thing</li><li>second thing</li></ul>",
         "A title of some words\nA first block of text, long enough to be one.\nsome code\nfirst thing\nsecond thing"),
        ("<h1>Terms in use</h1><p>What the words of this page mean in short.</p>"
         "<dl><dt>word</dt><dd>what it means</dd></dl><table><tr><td>one</td><td>two</td></tr></table>",
         "Terms in use\nWhat the words of this page mean in short.\nword\nwhat it means\none\ntwo"),
    ],
)
def test_short_articles_lists_and_tables_stay(spark, trees, article, text):
    assert text_of(spark, trees, FRAME.format(f"<article>{article}</article>")) == text


def test_without_trees_names_tell_other_parts(spark):
    page = FRAME.format("<div><h1>Title</h1><p>Text.</p></div><section class=comments><p>First!</p></section>")
    assert text_of(spark, None, page) == "Title\nText."
    assert text_of(spark, None, "<nav>Home</nav>") == ""
