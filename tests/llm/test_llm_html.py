from __future__ import annotations

import pytest

from barloom.llm import html

CASES = {
    "null": (None, ""),
    "empty": ("", ""),
    "no markup": ("  just \n text ", "just text"),
    "only markup": ("<html><body><nav><a>x</a></nav></body></html>", ""),
    "names of classes": (
        '<body><div id="header">Site</div><div class="menu"><a>Home</a> <a>About us</a></div><div id="content"><h1>Title</h1>'
        '<p>First &amp; more&nbsp;text.</p><div class="ad-box">Buy now</div><p>Second <b>bo</b>ld.</p><ul><li>one</li><li>two</ul>'
        '</div><div id="sidebar">Side text, long, long</div><div class="comments"><p>I like this very much and so on and on</p>'
        '</div><div class="footer">c 2020</div></body>',
        "Title\nFirst & more text.\nSecond bold.\none\ntwo",
    ),
    "elements": (
        "<body><header><h1>Site</h1></header><article><header><h1>T</h1></header><p>a<br>b</p><p>x < y &lt; z</p><aside>no</aside>"
        '<p>c<section class="comments"><article class="comment">me me me me</article></section></article><footer>f</footer>',
        "T\na b\nx < y < z\nc",
    ),
    "two articles": ("<article><p>short</p></article><article><p>the longer one</p></article>", "the longer one"),
    "three neighbouring asides": (
        '<article><h1>T</h1><p>one</p><div class="ad">ad</div><form>mail</form><aside>related</aside><div class="share">s</div>'
        "<p>the longer side</p></article>",
        "T\none\nthe longer side",
    ),
    "main and dialog": ('<main><p>m1</p><div role="dialog">d</div><p>m2</p></main><p>out</p>', "m1\nm2"),
    "hidden": ('<p>a</p><p hidden>b</p><p style="display: none">c</p><p>d</p>', "a\nd"),
    "script": ('<p>a</p><script>var x="<p>no</p>";</script><style>p{}</style><!-- <p>no</p> --><p>b</p>', "a\nb"),
    "attribute": ('<p title="a > b">t</p>', "t"),
    "names in values": (
        '<article><p>go to <a href="/trails/hidden-falls">the falls</a> and <a title="Our hidden gems">gems</a></p>'
        '<p data-id="share">b <a href="/view?id=login">c</a> <a href=/x?class=ad>d</a></p><p title = \'class="ad"\'>e</p>'
        "<p title='a'hidden>no</p><p ID = login>no</p></article>",
        "go to the falls and gems\nb c d\ne",
    ),
    "cut off": ("<article><p>hello</p><p>there <a hre", "hello\nthere"),
    "unclosed script": ("<article><p>x<script>foo", "x"),
    "form and notice": ('<div class="cookie-notice">We use cookies</div><p>Body</p><form><label>Name</label></form>', "Body"),
    "links alone": ("<p><a>one link</a> <a>two</a></p><p></p><p></p><p></p><div>text</div>", "text"),
}


@pytest.mark.parametrize("name", CASES)
def test_main_text(name):
    page, want = CASES[name]
    assert html.main_text(page) == want


def test_long_article_stays_whole():
    words = [f"word{i}" for i in range(200_000)]
    page = "<nav>n</nav><article>" + "".join(f"<p>{' '.join(words[i : i + 10])}</p>" for i in range(0, len(words), 10)) + "</article>"
    assert html.main_text(page).split() == words


def test_extract(spark):
    rows = [(i, f"u{i}", page, 1) for i, (page, _) in enumerate(CASES.values())] + [(None, None, "<p>é😀</p>", 1), (0, "u0", None, 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int").repartition(3)
    got = html.extract(df).collect()
    wants = [want for _, want in CASES.values()]
    assert len(got) == len(rows) and all(len(r.text) == r.n_chars for r in got)
    assert all(r.text == ("é😀" if r.page_id is None else wants[r.page_id]) for r in got)
    assert html.extract(df.limit(0)).count() == 0
