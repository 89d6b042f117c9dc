import time

import pytest

from ledgerline.llm import html_text as H

P1 = "A first paragraph, with commas, that is long enough to count as running text."
P2 = "A second one, which goes on a little, says something else, and then ends."


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("   \n", ""), ("<html><body></body></html>", ""), ("just text &amp; more", "just text & more"),
    (f"<nav><ul><li><a href=/>Home</a></ul></nav><article><h1>T</h1><p>{P1}<p>{P2}</article><footer>&copy;</footer>",
     f"T\n\n{P1}\n\n{P2}"),
    (f"<article><h1>T &lt;1&gt;</h1><p><b>{P1}<br><p>x &nbsp; y\n z</p></article>", f"T <1>\n\n{P1}\n\nx y z"),
    (f"<div id=top class='site-header'>Logo, slogan, motto</div><div class=page><h1>T</h1><div class=main><p>{P1}</p>"
     f"<div class=ad>Buy, buy, buy!</div><p>{P2}</p></div></div><div id='sidebar'><p>{P2}</p></div>", f"T\n\n{P1}\n\n{P2}"),
    (f"<div class='has-sidebar'><article><p>{P1}</p></article></div>", P1),
    (f"<main><p>{P1}</p><section id=comments><p>{P2}</p><form><p>Reply</p></form></section></main>", P1),
    (f"<article><p>{P1}</p><script>var t='</p><p>x</p>';</script><style>p{{}}</style><!-- <p>{P2}</p> -->"
     f"<p hidden>h</p><p style='display: none'>n</p><div role=alert>Cookies, please</div></article>", P1),
    (f"<article><section><h2>A</h2><p>{P1}</p></section><section><h2>B</h2><p>short</p></section></article>",
     f"A\n\n{P1}\n\nB\n\nshort"),
    (f"<article><ul><li>one<li>two</ul><table><tr><td>c<td>d</table><p>{P1}</p></article>", f"one\n\ntwo\n\nc\n\nd\n\n{P1}"),
    (f"<article><p>{P1}</p><ul><li><a>x</a><li><a>y</a><li><a>z</a></ul></article>", P1),
    (f"<article><header><h1>T</h1></header><p>{P1}</p><footer>by me</footer></article>", f"T\n\n{P1}"),
    ("<p>1 < 2 and <3 > 2</p>", "1 < 2 and <3 > 2"), ("<p>a<p>b</div></p>c", "a\n\nb\n\nc"),
    (f"<p title=\"a > b\" data-x='<p>'>{P1}</p>", P1),
])
def test_main_text(page, want):
    assert H.main_text(page) == want


LINKS = "".join(f"<li><a href=#{k}>A cited work with a long title, number {k}</a></li>" for k in range(4))


@pytest.mark.parametrize("page, want", [
    (f'<article><p>{P1}</p><h2 id="related-work">Related work</h2><p id="footprint">{P2}</p></article>',
     f"{P1}\n\nRelated work\n\n{P2}"),
    (f'<article><h2 id="menu-planning">Menus</h2><p class="shareholders">{P1}</p><p class="notice">{P2}</p></article>',
     f"Menus\n\n{P1}\n\n{P2}"),
    (f'<article><p>{P1}</p><section class="social-history"><p>{P2}</p></section><div class="footnotes">1 See a.</div>'
     '</article>', f"{P1}\n\n{P2}\n\n1 See a."),
    (f'<div><p>{P1}</p><h2 id="related-work">Related work</h2><p id="footprint">{P2}</p></div>',
     f"{P1}\n\nRelated work\n\n{P2}"),
    (f'<article class="post comments-open"><p>{P1}</p></article>', P1),
    (f'<article><p>{P1}</p></article><article hidden class="x"><p>{P2}</p></article>', P1),
    (f'<article class="commentary"><p>{P1}</p></article>', P1),
    (f'<div class="has-share"><main class="related"><p>{P1}</p></main></div>', P1),
    (f'<article><p>{P1}</p></article><div id="comments"><article class="comment-body"><p>{P2} {P2}</p></article></div>', P1),
    (f'<article><p>{P1}</p><div class="share-buttons">Tell</div><div class="related-posts"><p>{P2}</p></div>'
     f'<div class="site-footer">f</div></article>', P1),
    (f"<article><p>{P1}</p><ul>{LINKS}</ul></article>",
     "\n\n".join([P1, *(f"A cited work with a long title, number {k}" for k in range(4))])),
])
def test_names_take_only_furniture(page, want):
    assert H.main_text(page) == want


@pytest.mark.parametrize("page", [
    "<a " * 60_000, "<p x='" + "y" * 200_000, "<div>" * 20_000 + "deep", "<!--" + "-" * 200_000, "<" * 200_000,
    "<a b=" * 40_000, "<p " + "a" * 200_000 + ">t", "<script>" * 20_000, "</p>" * 50_000, "<li>" * 20_000 + "x",
    "&" * 100_000])
def test_hostile_pages_take_linear_time(page):
    began = time.process_time()
    H.main_text(page)
    assert time.process_time() - began < 20


def test_report(spark):
    rows = [(1, "u", f"<p>{P1}</p>", "x"), (1, "u", f"<p>{P1}</p>", "x"), (None, None, None, "x"), (2, "u", "", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, main_text string")
    got = sorted(map(str, map(tuple, H.html_report(pages).collect())))
    assert got == sorted(map(str, [(1, "u", P1, len(P1))] * 2 + [(None, None, "", 0), (2, "u", "", 0)]))
    assert H.html_report(pages.limit(0)).count() == 0


def test_title_in_a_box_of_its_own():
    prose = "".join(f"<p>Sentence {k}, with commas, and some more words to read here.</p>" for k in range(6))
    text = [f"Sentence {k}, with commas, and some more words to read here." for k in range(6)]
    page = f"<body><div><h1><a href='/'>Site</a></h1></div><div><h1>Title</h1></div><div><div>{prose}</div></div></body>"
    assert H.main_text(page) == "\n\n".join(["Title", *text])
    # A title of the container's own leaves other headings alone.
    page = f"<body><div><h1>Site</h1></div><div><div><h1>Title</h1>{prose}</div></div></body>"
    assert H.main_text(page) == "\n\n".join(["Title", *text])
    page = f"<body><div><div><h1>Title</h1></div></div><article>{prose}</article></body>"
    assert H.main_text(page) == "\n\n".join(["Title", *text])
