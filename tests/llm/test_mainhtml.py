from __future__ import annotations

import pytest

from renewline.llm import mainhtml
from tests.llm import data

A, B, C = (data.prose(s, 60) for s in (1, 2, 3))
MENU = "<nav><ul>" + "".join(f'<li><a href="/{i}">entry {i}</a></li>' for i in range(9)) + "</ul></nav>"
SIDE = '<aside class="sidebar"><h3>Latest</h3><p><a href="/x">something else to read</a></p></aside>'

CASES = {
    "marked article": (
        f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t='</p><p>no';</script></head><body>{MENU}"
        f"<!-- <p>no</p> --><div class=\"ad\">Buy</div><article><h1>Title</h1><p>{A}</p><p>{B}</p></article><footer>&copy; x</footer></body></html>",
        ["Title", A, B],
    ),
    "unclosed paragraphs and broken end": (f"<body>{MENU}<article><h1>T</h1><p><b>{A}<br><p>{B}&amp;<p>{C} <a hre", ["T", A, B + "&", C]),
    "no mark, by density": (
        f"<html><body><div id=top><a href=1>Home</a> <a href=2>News</a></div><div><h1>Title</h1><div><p>{A}</p><p>{B}</p><p>Short.</p></div></div>"
        f"<div><a href=1>One</a><a href=2>Two</a><a href=3>Three</a></div></body></html>",
        ["Title", A, B, "Short."],
    ),
    "boilerplate by class, id and role": (
        f'<body><div class="site-header">Name</div><main><h2>T</h2><p>{A}</p><div class="share social">Share</div><p>{B}</p>'
        f'<section id="comments"><p>{C}</p></section><div role="alert">Careful</div></main><div class="cookie-notice">We use</div>{SIDE}</body>',
        ["T", A, B],
    ),
    "boilerplate by one word of a class": (
        f'<body class="has-sidebar"><div class="layout with-sidebar"><article><p>{A}</p><div class="post-comments"><p>no</p></div>'
        f'<div class="comments-area" id="c1"><p>no</p></div><p>{B}</p></article></div><div class="left_sidebar"><p>{C}</p></div></body>',
        [A, B],
    ),
    "article within a suspect element": (
        f'<body><div class="banner wrapper"><p>no</p><main><p>{A}</p></main></div><div class="header"><p>Site</p></div></body>',
        [A],
    ),
    "blocks and white space": (
        "<article><p>a  b\n\tc<br>d</p><ul><li>one<li>two</ul>loose <i>text</i> here<table><tr><td>x<td>y</table><pre>p  q</pre></article>",
        ["a b c d", "one", "two", "loose text here", "x", "y", "p q"],
    ),
    "references": ("<article><p>&lt;b&gt; &eacute;&#233;&#xe9; &copy &nbsp; &unknown; AT&T</p></article>", ["<b> ééé © &unknown; AT&T"]),
    "forms and hidden parts": (
        f"<article><p>{A}</p><form><label>Name</label><input value=x><button>Go</button></form><p hidden>no</p><p style='display: none'>no</p>"
        f"<noscript><p>no</p></noscript><iframe><p>no</p></iframe><p>{B}</p></article>",
        [A, B],
    ),
    "stray tags": (f"</div></p><article></span><p>{A}</p></div><p>{B}</b></p></article></div>", [A, B]),
    "header inside and outside": (f"<header><p>Site</p></header><article><header><h1>T</h1></header><p>{A}</p></article>", ["T", A]),
    "plain text": (A, [A]),
    "angle brackets that are no tags": (f"<article><p>1 < 2 and 3 > 2 {A}</p></article>", [f"1 < 2 and 3 > 2 {A}"]),
    "empty": ("", []),
    "only markup": ("<html><body><script>x</script></body></html>", []),
}


@pytest.mark.parametrize("name", CASES)
def test_pages(name):
    page, blocks = CASES[name]
    assert mainhtml.main_text(page) == "\n\n".join(blocks)


def test_density_formula():
    root = mainhtml.parse("<body><div><p>abcdefghij</p></div><div><a>abcde</a><a>fghij</a></div></body>")
    mainhtml._measure(root)
    body = root.children[0]
    text, links = body.children
    assert (text.chars, text.tags, text.link_chars) == (10, 1, 0)
    assert (links.chars, links.tags, links.link_chars, links.link_tags) == (10, 2, 10, 2)
    assert text.density > links.density >= 0
    assert body.sum == text.density + links.density


def test_very_deep_and_long_pages():
    deep = "<div>" * 20_000 + "x" * 50 + "</div>" * 20_000
    assert mainhtml.main_text(deep) == "x" * 50
    assert len(mainhtml.main_text("<article>" + f"<p>{A}</p>" * 20_000 + "</article>")) == 20_000 * (len(A) + 2) - 2


def test_query(spark, tmp_path):
    pages = [(i, f"http://x/{i}", page, "extra", 5) for i, (page, _) in enumerate(CASES.values())]
    pages += [(100, None, None, None, None), (None, None, "<p>a</p>", "x", 1), pages[0]]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, text string, n_chars int")
    rows = mainhtml.op7_main_text(spark, data.parquet(df, tmp_path, "pages")).collect()
    assert len(rows) == len(pages)
    expected = ["\n\n".join(b) for _, b in CASES.values()]
    for r in rows:
        assert r.n_chars == len(r.text)
        if r.page_id is not None and r.page_id < 100:
            assert r.text == expected[r.page_id]
    assert {r.text for r in rows if r.page_id == 100} == {""}
    empty = data.parquet(df.where("false"), tmp_path, "pages")
    assert mainhtml.op7_main_text(spark, empty).count() == 0


D, E = (data.prose(s, 60) for s in (4, 5))


@pytest.mark.parametrize("page,blocks", [
    # All parts of a split article stay, text between them goes.
    (f"<body>{MENU}<article><p>{A}</p><p>{B}</p></article><p>Advertisement</p><article><p>{C}</p></article><article><p>{D}</p></article></body>", [A, B, C, D]),
    # A mark on a teaser does not outweigh the dense part of the page.
    (f"<body><article><p>Short teaser.</p></article><div><p>{A}</p><p>{B}</p><p>{C}</p></div></body>", [A, B, C]),
    # A list of links within the mark falls short of the threshold.
    (f"<body><article><div><p>{A}</p><p>{B}</p><p>{C}</p></div><ul>" + "".join(f'<li><a href="/{i}">link {i}</a></li>' for i in range(9)) + "</ul></article></body>", [A, B, C]),
    # Sections below the average density of their article stay.
    (f"<body><article><section><p>{A}</p><p>{B}</p><p>{C}</p></section><section><p>{D}</p><p>{E[:90]}</p><p>{E[:60]}</p></section></article></body>", [A, B, C, D, E[:90].strip(), E[:60].strip()]),
])
def test_density_decides_on_marked_pages(page, blocks):
    assert mainhtml.main_text(page) == "\n\n".join(blocks)
