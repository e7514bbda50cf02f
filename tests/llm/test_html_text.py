import html
import re

import numpy as np
import pytest

from riskweave.llm import html_text
from riskweave.llm.html_text import blocks, extract, main_text
from riskweave.llm.queries import QUERIES

P = "One sentence, and another. A third one; it goes on and on, as text does. "
PAGES = {
    "plain": ("<p>hello\n world</p>", "hello world"),
    "no markup": ("just text &amp; more &lt;b&gt; &copy;", "just text & more <b> ©"),
    "article": (f"<body><nav><a href=x>menu</a></nav><article><h1>T</h1><p>{P}</p><p>x</p></article><footer>{P}</footer></body>", f"T {P}x"),
    "div": (f"<div class='top nav'>a</div><div id=content><h1>T</h1><p>{P}</p><ul><li>i<li>j</ul></div><div class='sidebar'>{P}</div>", f"T {P}i j"),
    "parts": (f"<main><p>{P}</p><form>Name <input></form><div class=ad>{P}</div><section id='comments'><p>{P * 5}</p></section><p>{P}</p></main>", f"{P}{P}".strip()),
    "unclosed": (f"<article><h1>T</h1><p><b>Bold.<br><p>{P}<p>a<i>b</i>c", f"T Bold. {P}abc"),
    "scripts": (f"<article><script>var t='</p><p>no</p>';</script><style>p{{}}</style><!-- <p>no</p> --><p>{P}</p><textarea><p>no</textarea></article>", P.strip()),
    "quoted": (f"<article><p title='a>b' data-x=\"<p>\">{P}</p></article>", P.strip()),
    "links": (f"<div><ul><li><a href=1>{P}</a></ul></div><div><p>{P * 3}</p></div>", (P * 3).strip()),
    "raw end": ("<p>a</p><script>never closed <p>b</p>", "a"),
    "header": (f"<header><h1>Site</h1></header><article><header><h1>T</h1></header><p>{P}</p></article>", f"T {P}".strip()),
    "hidden": (f"<article><p>{P}</p><div hidden>no</div></article>", P.strip()),
    "only menus": ("<nav>a</nav><footer>b</footer>", ""), "empty": ("", ""), "null": (None, ""), "broken": ("<<p<>>&#xZZ; <", "<"),
}


@pytest.mark.parametrize("name", [n for n in PAGES if n != "broken"])
def test_pages(name):
    page, text = PAGES[name]
    assert main_text(page) == text.strip()


def test_broken_markup_and_long_pages_end():
    main_text(PAGES["broken"][0])
    long = "<article>" + f"<div><p>{P}" * 20_000
    assert len(main_text(long)) == 20_000 * len(P) - 1
    assert len(main_text("<div>" * 20_000 + P + "</p>" * 20_000)) == len(P) - 1
    main_text("<a '" * 50_000)
    main_text('<p x="' + "y" * 100_000)


def test_references_are_decoded_once():
    assert [b.text for b in blocks("<p>&amp;amp; &eacute;&#233;&nbsp;x</p>")[0]] == ["&amp; éé x"]


def test_rows_pass_through(spark):
    rows = [(1, "u", PAGES["article"][0], "x"), (1, "u", PAGES["article"][0], "x"), (None, None, None, "x"), (3, None, "", None)]
    got = extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    text = PAGES["article"][1].strip()
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, "u", text, len(text))] * 2 + [(None, None, "", 0), (3, None, "", 0)], key=str)
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_whole_table(spark, folder):
    got = {r.page_id: r for r in QUERIES["op4_html_text"](spark, folder).collect()}
    pages = spark.read.parquet(f"{folder}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:  # in these pages the article is marked
        inside = re.search(r"<article>(.*?)(</article>|\Z)", p.html, re.S)[1]
        want = " ".join(html.unescape(re.sub(r"<(br|/?p|/?h1)>", " ", re.sub(r"</?b>", "", inside))).split())
        assert got[p.page_id].text == want and got[p.page_id].n_chars == len(want)


@pytest.mark.parametrize("name", ["lead", "closing", "long block"])
def test_pages_without_a_marked_article_are_whole(name):
    page, text = {
        "lead": (f"<div id=content><p>{P}</p><div class=body>{f'<p>{P}</p>' * 20}</div></div>", P * 21),
        "closing": (f"<div id=content><div class=body>{f'<p>{P}</p>' * 20}</div><ul><li>one<li>two</ul><div class=end><p>{P}</p></div></div>", f"{P * 20}one two {P}"),
        "long block": (f"<div class=x><div class=one><p>{P}</p><p>{P}</p><p>{P}</p></div><div class=two><blockquote>{P * 300}</blockquote></div></div>", P * 303),
    }[name]
    nav = f"<div class=nav><a href=x>{P}</a></div>"
    assert main_text(nav + page) == text.strip()


def test_ratios_decide_what_names_and_tags_do_not_say(monkeypatch):
    """Comments of an unlisted class after the text go, by their ratios alone."""
    comments = "".join(f"<div class=zq><b>reader {i}</b><p>I think so, too.</p></div>" for i in range(4))
    page = f"<article><h1>T</h1>{f'<p>{P}</p>' * 6}<table><tr><td>1<td>2</table><div class=wall>{comments}</div></article>"
    assert main_text(page) == f"T {P * 6}1 2"
    monkeypatch.setattr(html_text, "path_ratios", lambda own: np.ones(len(own)))
    assert main_text(page) != f"T {P * 6}1 2"


@pytest.mark.parametrize("name", ["legal", "share", "social-history", "search", "comment", "banner"])
def test_listed_names_with_the_text_stay(name):
    inner = f"<h1>T</h1><p>{P}</p><p>{P}</p>"
    assert main_text(f"<nav><a href=x>menu</a></nav><div class='{name}'>{inner}</div><footer>x</footer>") == f"T {P}{P}".strip()


def test_a_part_that_may_be_beside_the_article_stays_if_it_holds_as_much():
    page = f"<article><p>{P}</p><div class=legal><p>{P}</p><p>{P * 2}</p></div><div class=share>Send it.</div><p>{P}</p></article>"
    assert main_text(page) == f"{P}{P}{P * 2}{P}".strip()


def test_sections_with_headings_and_formulas_stay():
    sections = "".join(f"<div class=s><h2>H{i}</h2><p>Short one, here.</p></div>" for i in range(3))
    page = f"<main>{f'<p>{P}</p>' * 6}{sections}<p>a <math><mi>x</mi></math> b</p><object>told so</object></main>"
    assert main_text(page) == f"{P * 6}{' '.join(f'H{i} Short one, here.' for i in range(3))} a x b told so"
