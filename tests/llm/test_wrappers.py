"""Wrappers of pages: expressions by hand, texts against a plain cut of the article, page by page edges."""

import html
import itertools
import json
import re

import pytest

from millrace.llm import wrappers
from millrace.llm.page_tokens import Page, key_of
from millrace.llm.wrappers import Wrapper, main_text


def wrapper(*pages):
    out = Wrapper()
    for page in pages:
        out.absorb(Page(page))
    return out


def plain_article(page):
    """The article of the given tables by cutting alone: everything between its tags, block by block."""
    article = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    blocks = re.split(r"</?(?:p|h1)>", article)
    texts = (re.sub("<[^>]*>", lambda m: " " if m.group() == "<br>" else "", b) for b in blocks)
    return "\n".join(filter(None, (" ".join(html.unescape(t).split()) for t in texts)))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_tables_equal_plain_cut(spark, sf):
    pages = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in wrappers.main_texts(pages.repartition(3)).collect()}
    assert got == {r["page_id"]: plain_article(r["html"]) for r in pages.collect()}


def test_expression():
    got = wrapper("<ul><li>a<li>b</ul><p>x", "<ul><li>c</ul><p>y<p>z", "<h2>t</h2><ul><li>c</ul><p>y<div>q</div><p>w")
    assert got.expression() == '(h2("))? ul((li(#))+) ((p(#))+ div(")?)+'.replace('(h2("))?', 'h2(")?')


def test_a_token_that_comes_again_makes_a_group():
    assert wrapper("<p>1<div>a</div><p>2").expression() == '((p(#))+ div("))+'
    a, b = wrapper("<dl><dt>1<dd>2</dl>"), wrapper("<dl><dd>3<dt>4</dl>")
    a.merge(b)
    assert a.expression() == "dl((dt(#) dd(#))+)"


def test_merging_in_any_order_gives_the_same_rule():
    pages = [
        f"<div class=top>Same head</div><div class=c><h1>T{i}</h1><p>{'text ' * i}{i}</p>"
        f"{'<ul><li>x' + str(i) + '</ul>' if i % 2 else ''}<p>Subscribe to us</p></div><div class='end x{i}'>bye</div>"
        for i in range(1, 13)
    ]
    rules = []
    for order in itertools.permutations(range(3)):
        parts = [wrapper(*pages[k * 4 : k * 4 + 4]) for k in order]
        whole = Wrapper()
        for part in parts:
            whole.merge(Wrapper.load(part.dump()))
        rules.append(json.dumps(whole.rule()))
    assert len(set(rules)) == 1 and rules[0] == json.dumps(wrapper(*pages).rule())


def test_many_class_names_become_a_slot():
    letters = [a + b for a in "abcdefgh" for b in "abcdefgh"]
    pages = [f"<div class='post-{x}'><p>some longer text {x}</p></div><div class=foot-links>all {x}</div>" for x in letters]
    got = wrapper(*pages)
    assert len(got.keys) < 10 and "div.*" in got.keys
    halves = wrapper(*pages[:20]), wrapper(*pages[20:])
    halves[0].merge(halves[1])
    assert sorted(halves[0].keys) == sorted(got.keys)


def test_template_texts_of_a_host_without_marks():
    pages = [f"<div><div>Menu here</div><div><h1>Title {i}</h1><p>Body {i} " + f"w{i} " * 50 + "</p><p>Read our terms</p></div></div>" for i in range(20)]
    rule = wrapper(*pages).rule()
    assert main_text(pages[3], rule).split("\n")[0] == "Title 3"
    shared = [f"<div><p>Body {i} " + f"w{i} " * 50 + "</p><b>x</b></div><div>All rights</div>" for i in range(20)]
    rule = wrapper(*shared).rule()
    assert "All rights" not in main_text(shared[3], rule)


def test_copies_on_a_host_keep_their_text():
    page = "<div><h1>Title</h1><p>The same words on every page.</p></div>"
    assert main_text(page, wrapper(*[page] * 50).rule()) == "Title\nThe same words on every page."


PAGES = {
    # markup, references, white space
    "<article><h1>A &amp; B</h1><p>x &lt;y&gt;\n\t z&nbsp;q &#233;&#x41; &am &copy</p></article>": "A & B\nx <y> z q éA &am ©",
    "<article><p>one <b>two</b><i>three</i><br>four</article>": "one twothree four",
    "<article>bare <p>para<p>next<ul><li>a<li>b<ul><li>c</ul></ul>tail</article>": "bare\npara\nnext\na\nb\nc\ntail",
    "<article><table><tr><td>1<td>2<tr><td>3</table><pre>a\n  b</pre></article>": "1\n2\n3\na b",
    # what goes
    "<header>Site</header><nav>m</nav><main><h1>T</h1><p>x</p><aside>s</aside></main><footer>f</footer>": "T\nx",
    "<article><header><h1>T</h1></header><p>x</p><footer>by me</footer></article>": "T\nx",
    "<div class='cookie-notice'>We use</div><article>t<div class=ad>buy</div><p>u</article>": "t\nu",
    "<article><p>x</p><section class=comments><h2>2 comments</h2><article>me too</article></section></article>": "x",
    "<article><p>x</p></article><section id=comments><article>me too, and this is a much longer text</article></section>": "x",
    "<article><p>x <span class=ad>buy</span>y<button>go</button></p><form><p>mail<input></form></article>": "x y",
    "<article><!-- <p>no</p> --><script>'</article>'</script><style>p{}</style><p>x</p><noscript>n</noscript></article>": "x",
    "<article><p hidden>h</p><p style='display: none'>n</p><p>x</p><div aria-hidden=true>a</div></article>": "x",
    "<body class='has-sidebar comments-open'><article class='post comments-open'>x</article>": "x",
    "<div role=main><p>x</p></div><div role=complementary>y</div>": "x",
    "<div id=sidebar>s</div><div id=content><h1>T</h1><p>some text</p></div><div class=siteFooter>f</div>": "T\nsome text",
    "<form id=page><nav>m</nav><article><p>x</p></article></form>": "x",
    "<form><nav>m</nav><div><h1>T</h1><p>words</p></div></form>": "T\nwords",
    # broken
    "": "",
    "   ": "",
    "plain text &amp; no tags": "plain text & no tags",
    "<article><p>cut off <a href='x": "cut off",
    "<article><p title=it's>Don't <b>stop</article>": "Don't stop",
    "<article><p>1 < 2 and 3 > 2</p></div></article>": "1 < 2 and 3 > 2",
    "<script>never closed <article>x</article>": "",
    "<title>t</title><article>x</article>": "x",
    "<head><title>t</title><p>x": "x",
    "<ARTICLE><P>Upper</P></ARTICLE>": "Upper",
    "<nav>only a menu</nav>": "",
}


@pytest.mark.parametrize("page", PAGES)
def test_page(page):
    assert main_text(page, None) == PAGES[page]
    assert main_text(page, wrapper(page, page).rule()) == PAGES[page]
    assert main_text(page, {"paths": [["html", "elsewhere@"]], "drop": []}) == PAGES[page]


def test_long_and_deep_pages():
    assert main_text("<div>" * 20_000 + "deep", None) == "deep"
    paragraphs = "".join(f"<p>p{i}</p><h2>h{i}</h2>" for i in range(20_000))
    assert main_text(f"<article>{paragraphs}</article>", None).count("\n") == 39_999
    wrapper("<div>" * 3000 + "deep").expression()
    assert main_text("<p " * 50_000, None) == ""


def test_attributes():
    assert key_of("div", ' class="b a x9" data-class="ad"') == "div.a.b"
    assert key_of("div", " class=adBanner") == "div.adBanner!"
    assert key_of("div", " class='readability load'") == "div.load.readability"
    assert key_of("p", " hidden") is None


def test_edges_of_the_table(spark):
    page = "<nav>m</nav><article>x</article>"
    rows = [
        (1, "http://a.b/1", page, 1, 1),
        (1, "http://a.b/1", page, 1, 1),
        (2, "http://A.b:80/2", None, 1, 1),
        (None, None, page, 1, 1),
        (4, "no url", "", 1, 1),
        (5, "https://u:p@a.b?x", "<article>y", 1, 1),
    ]
    schema = "page_id bigint, url string, html string, host int, rule int"
    got = wrappers.main_texts(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r["page_id"] or 0, r["text"]) for r in got) == [(0, "x"), (1, "x"), (1, "x"), (2, ""), (4, ""), (5, "y")]
    found = wrappers.infer_wrappers(spark.createDataFrame(rows, schema)).collect()
    assert [(r["host"], r["pages"]) for r in found] == [("a.b", 4)]
    assert wrappers.main_texts(spark.createDataFrame([], schema)).collect() == []


def test_a_task_hands_on_when_it_holds_many_places(spark, monkeypatch):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    whole = {tuple(r)[:2] for r in wrappers.infer_wrappers(pages).collect()}
    monkeypatch.setattr(wrappers, "_NODES", 5)
    assert {tuple(r)[:2] for r in wrappers.infer_wrappers(pages).collect()} == whole
