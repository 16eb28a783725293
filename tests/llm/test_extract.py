from __future__ import annotations

import html as H
import re

import pytest
from pyspark.sql import functions as F

from quoteloom.llm import extract as x

PAGE = (
    '<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body>'
    "<header>top</header><nav><ul><li><a href=1>m</a></li></ul></nav><div class='ad'>buy</div>"
    "<article><h1>Head &amp; all</h1><p><b>One<br>two<p>Th<i>r</i>ee\n four</p><aside>side</aside>"
    "<div id=comments><p>me first</p></div></article><footer>&copy; x</footer></body></html>"
)


def test_a_page():
    assert x.main_text(PAGE, []) == "Head & all One two Three four"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("plain &lt;b&gt; text", "plain <b> text"),
        ("<article>cut <b", "cut"),
        ("<article>1 < 2 > 0 <!-- c --> &eacute;", "1 < 2 > 0 é"),
        ("<article>a<!-- never closed <p>b", "a"),
        ("<body><main><p>x</p></main><p>y", "x"),
        ("<body><div class='post-content'>x<p>y</div><div>z</div>", "x y"),
        ("<body><ul><li>a<li>b</ul><p>" + "word " * 50 + "</p>", "a b " + ("word " * 50).strip()),
        ("<article><table><tr><td>a<td>b<tr><td>c</table>", "a b c"),
        ("<article><p title='a>b'>q</p></article></div>", "q"),
        ("<article><form>f</form><style>s</style><p>p", "p"),
    ],
)
def test_odd_markup(page, text):
    assert x.main_text(page, []) == text


def test_wrapper_has_options_repeats_and_slots():
    one = x.page_tree("<body><h1>a</h1><p>b</p><p>c<b>d</b></p>")
    two = x.page_tree("<body><h1>a</h1><div>n</div><p>b</p><dl><dt>k<dd>v<dt>k<dd>v</dl>")
    assert x.align(one, two).expression() == (
        "<><body><h1>#</> <div>#</>? <p># <b>#</>?</>+ <dl>(<dt>#</> <dd>#</>)+</>?</></>"
    )


def test_host_places_hold_for_its_pages(spark):
    body = lambda i: f"<body><div class=x>menu menu</div><div class=y><p>{'text ' * 40}{i}</p></div>"
    rows = [(i, f"http://h.org/{i}", body(i), "clash") for i in range(20)]
    rows += [(90, None, None, ""), (91, "nohost", "", ""), (None, "http://h.org/z", "<body><div class=z>alone", "")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    found = {r.page_id: r.text for r in x.extract(frame).collect()}
    assert found[3] == "text " * 40 + "3"
    assert "menu" not in found[3] and found[90] == "" and found[91] == "" and found[None] == "alone"
    assert x.extract(frame.limit(0)).count() == 0


def test_pages_table_equals_a_plain_reading(spark):
    """All pages here have one article of h1, p, b and br; a plain reading is exact."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in x.extract(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", r.html or "", re.S)
        inner = re.sub(r"<[a-z/][^>]*\Z", "", inner[1]) if inner else ""
        parts = re.split(r"</?(?:h1|p|br)>", re.sub("</?b>", "", inner))
        want = " ".join(" ".join(H.unescape(p).split()) for p in parts if p.strip())
        assert got[r.page_id] == " ".join(want.split()), r.page_id


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<body class='has-sidebar'><article><p>x</article>", "x"),
        ("<body class=sidebar><p>x", "x"),
        ("<div id=page class='layout no-sidebar'><article><p>x</article></div>", "x"),
        ("<div class=widget><article><p>x</article></div>", "x"),
        ("<article class='post comment-status-open'><p>x</article>", "x"),
        ("<article><p class='share-price'>x<section id='search-methods'>y</section><div class='ad'>z</div></article>", "x y"),
        ("<article id='post-12'><p>x<div id=comments>z</div></article>", "x"),
    ],
)
def test_only_whole_names_drop_an_element(page, text):
    assert x.main_text(page, []) == text


def test_deep_and_long_pages(spark):
    deep = "<body>" + "<div>" * 5000 + "far down" + "<b>" * 5000 + " end"
    long = "<body><article>" + "".join(f"<h2>t{i}</h2><p>w{i}</p><ul><li>l{i}</ul>" for i in range(3000))
    rows = [(i, f"http://h.org/{i}", page) for i, page in enumerate([deep, deep, deep + "!", long, long + "<p>x"])]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in x.extract(frame).collect()}
    assert found[0] == found[1] == "far down end" and found[2] == "far down end!"
    assert found[3] == " ".join(f"t{i} w{i} l{i}" for i in range(3000)) and found[4] == found[3] + " x"
    tree = x.page_tree(deep)
    assert x.Element.read(tree.stored()).expression() == tree.expression()


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<body><h1>Title</h1><p>Lead</p><div>" + "long " * 50 + "</div><div class=x>menu</div>", "Title Lead " + ("long " * 50).strip()),
        ("<article>teaser</article><div class='content'>" + "story " * 20 + "</div>", "teaser " + ("story " * 20).strip()),
        ("<main><article>" + "story " * 20 + "</article><p>more</p></main>", ("story " * 20).strip()),
        ("<article>" + "story " * 20 + "</article><div class='content'>less</div>", ("story " * 20).strip()),
    ],
)
def test_no_place_hides_a_larger_one(page, text):
    assert x.main_text(page, []) == text


def test_alignment_equals_the_longest_common_order():
    import itertools
    import random

    rng = random.Random(4)
    for _ in range(200):
        one, two = ([rng.choice("abcdefg") for _ in range(rng.randrange(7))] for _ in range(2))
        # no tandem repeats, which would be folded
        one, two = ([k for k, _ in itertools.groupby(t)] for t in (one, two))
        both = x.align(*(x.Element("", parts=[x.Element(k) for k in t]) for t in (one, two)))
        if any("+" in p.flags for p in both.parts):
            continue
        keys = [(p.key, "?" in p.flags) for p in both.parts]
        shared = sum(not optional for _, optional in keys)
        longest = max(
            n for n in range(len(one) + 1) for c in itertools.combinations(one, n) if is_part(c, two)
        )
        assert shared == longest and is_part(one, [k for k, _ in keys]) and is_part(two, [k for k, _ in keys])


def is_part(some, whole):
    rest = iter(whole)
    return all(k in rest for k in some)


@pytest.mark.parametrize("name", ["comment-list", "sidebar-left", "ad-slot", "user_comments", "site-footer", "main-nav"])
def test_names_of_known_words_drop_an_element(name):
    assert x.main_text(f"<article><p>x<div class='{name}'><p>y</div></article>", []) == "x"
    assert x.main_text(f"<body class={name}><article><p>x</article>", []) == "x"


def site(pages, article=False):
    """Pages of a plain template: a menu, a label and a foot that say the same on each."""
    body = "article" if article else "div"
    return [
        "<body><div><p>Home</p><p>News</p><p>About us</p></div>"
        f"<{body}><h1>{title}</h1><h2>Today</h2>" + "".join(f"<p>{p}</p>" for p in text) + f"</{body}><div>All rights reserved</div>"
        for title, text in pages
    ]


STORIES = [(f"Title {i}", [f"story {i} says {k} " + "word " * 20 for k in range(i % 3 + 1)]) for i in range(7)]


def told(story, *label):
    title, text = story
    return " ".join(" ".join([title, *label, *text]).split())


def read_host(spark, pages):
    rows = [(i, f"http://plain.org/{i}", page) for i, page in enumerate(pages)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    return [r.text for r in x.extract(frame).orderBy("page_id").collect()]


def test_texts_that_differ_are_slots_and_constant_blocks_go(spark):
    assert read_host(spark, site(STORIES)) == [told(s) for s in STORIES]
    # an article's own labels stay
    assert read_host(spark, site(STORIES, article=True)) == [told(s, "Today") for s in STORIES]


def test_what_is_no_template_stays(spark):
    # two pages are no evidence
    assert "Today" in read_host(spark, site(STORIES[:2]))[0]
    # copies of one page hold no slot
    same = read_host(spark, site(STORIES[:1]) * 6)
    assert all(told(STORIES[0], "Today") in text for text in same)
    # a block that a page does not have, or has with another text, is none
    pages = [*site(STORIES[:5]), *(p.replace("<h2>Today</h2>", new) for p, new in zip(site(STORIES[5:]), ("", "<h2>Now</h2>")))]
    got = read_host(spark, pages)
    assert got[0] == told(STORIES[0], "Today") and got[5] == told(STORIES[5]) and got[6] == told(STORIES[6], "Now")


def test_a_constant_word_inside_a_block_that_differs_stays():
    trees = [x.page_tree(f"<body><p>By <b>the desk</b> on {d}</p><p>{'text ' * 9}{d}<hr></p><div>foot</div>") for d in "abc"]
    wrapper = x.align(x.align(trees[0], trees[1]), trees[2])
    fixed = x.template(wrapper)
    assert len(fixed) == 1 and wrapper.pages == 3
    page = "<body><p>By <b>the desk</b> on d</p><p>text</p><div>foot</div>"
    assert x.main_text(page, x.places(wrapper, fixed=fixed), fixed) == "By the desk on d text"
