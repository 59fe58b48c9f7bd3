"""Operator 6 on pages of many makes, and against the articles of the test table."""

import re
from html import unescape

import pytest
from skein.llm import html_extract as h

LONG = "A paragraph of the article, long enough to count, with a comma or two, and then some."
MENU = "".join(f"<li><a href={i}>Menu item {i}</a>" for i in range(6)).join(("<ul>", "</ul>"))


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p {{}}</style><script>var t='<p>no</p>';</script></head><body>{body}</body></html>"


@pytest.mark.parametrize(
    "body, text",
    [
        (f"<nav><a href=x>menu</a></nav><article><h1>Title</h1><p>{LONG}</p></article><footer>foot</footer>", f"Title {LONG}"),
        (f"<div class='site-header'>Site</div><div id=content><h2>T</h2><p>{LONG}<p>{LONG}<ul><li>one<li>two</ul></div><div class=sidebar><p>{LONG}</p></div>", f"T {LONG} {LONG} one two"),
        (f"<main><p>{LONG}</p><aside>{LONG}</aside><form>f <input><select><option>o</select></form><div class='ad'>{LONG}</div><p>{LONG}</p></main>", f"{LONG} {LONG}"),
        (f"<article><p>{LONG}</p><section class='comments'><p>{LONG} {LONG} {LONG}</p></section></article><div id=comments><article><p>{LONG}</p></article></div>", LONG),
        (f"<div class='cookie-notice'>{LONG}</div><div><p>a&amp;b &lt;c&gt; &eacute;&#233;&#xe9; &nbsp;d &amp e {LONG}</p></div>", f"a&b <c> ééé d & e {LONG}"),
        (f"<div><p><b>one<br>two<p>three <i>fo</i>ur\n\t five {LONG}</div>", f"one two three four five {LONG}"),
        (f"<div><!-- <p>no</p> --><p title='a > b'>{LONG}</p><p hidden>no</p><p style='display:none'>no</p><div role=navigation>no</div></div>", LONG),
        (f"<article><header><h1>In</h1></header><p>{LONG}</p><footer>no</footer></article>", f"In {LONG}"),
        (f"<div><p>{LONG}</p></b></div></div></span><p>{LONG}</p>", f"{LONG} {LONG}"),
        (f"<div><h1>T</h1><div><p>{LONG} {LONG}</p><p>{LONG}</p></div><h2>U</h2><p>short</p><ul><li><a href=1>link one</a><li><a href=2>link two</a></ul></div>", f"T {LONG} {LONG} {LONG} U short"),
        # menus without a name beside and inside the container; lists with some links stay
        (f"<div class=x>{MENU}</div><p>{LONG}</p><ul><li>one<li><a href=1>two</a></ul><p>{LONG}</p><div>{MENU}</div>", f"{LONG} one two {LONG}"),
        # comments that are longer than the article, under other names
        (f"<div><p>{LONG}</p></div><section class=discussion><p>{LONG} {LONG} {LONG}</p></section>", LONG),
        (f"<article><p>{LONG}</p></article><ol class=thread><li><p>{LONG} {LONG} {LONG}</p></ol>", LONG),
        (f"<div id=content><div class='article-header'><h1>T</h1></div><div class=article-body><p>{LONG}</p><p>{LONG}</p></div></div>", f"T {LONG} {LONG}"),
        (f"<div class=topnav><a href=1>a</a></div><article><p>{LONG}</p><ul><li><a href=1>a</a><li><a href=2>b</a><li><a href=3>c</a></ul></article>", f"{LONG} a b c"),
        ("<ul><li><a href=1>only links here, quite long, really long</a></ul>", ""),
        ("", ""),
    ],
)
def test_pages(body, text):
    assert h.main_text(page(body)) == text


PAGE = "".join(f"<p>{LONG} {i}</p>" for i in range(20))
TEXT = " ".join(f"{LONG} {i}" for i in range(20))


@pytest.mark.parametrize(
    "body, text",
    [
        # a teaser is the page's only article element: before, behind and inside the text
        (f"<article class=card><p>{LONG}</p></article><div id=content>{PAGE}</div>", TEXT),
        (f"<div id=content>{PAGE}</div><section><article class=card><h2>T</h2><p>{LONG}</p></article></section>", TEXT),
        (f"<div id=content>{PAGE}<article class=card><p>{LONG}</p></article></div>", f"{TEXT} {LONG}"),
        # a sibling that scores beside the article, and one that doesn't
        (f"<article>{PAGE}</article><div>{PAGE}</div><div><p>{LONG}</p></div>", f"{TEXT} {TEXT}"),
        (f"<article>{PAGE}</article><ol class=thread>" + f"<li><p>{LONG} {LONG}</p>" * 60 + "</ol>", TEXT),
    ],
)
def test_only_article_against_scores(body, text):
    assert h.main_text(page(body)) == text


SIDE = f"<div class=sidebar><p>{LONG} side</p></div><form><p>{LONG} form</p><input></form>"
TALK = "<section class=comments>" + f"<p>{LONG} said</p>" * 90 + "</section>"


@pytest.mark.parametrize(
    "body, text",
    [
        *((f"<div class='{c}'><article>{PAGE}</article>{SIDE}</div>", TEXT) for c in ("site no-sidebar", "content-with-sidebar", "page has-nav", "share-enabled")),
        (f"<div class='post comments-open'><h1>T</h1><div>{PAGE}</div>{TALK}</div>", f"T {TEXT}"),
        (f"<div class='page has-nav'><div id=share-enabled>{PAGE}</div>{SIDE}</div>{TALK}", TEXT),
        (f"<form id=aspnet>{PAGE}<div class=ad>{LONG}</div><input></form>", TEXT),
        (f"<form id=aspnet><input><div class='site has-nav'><main>{PAGE}</main>{SIDE}</div></form><footer>f</footer>", TEXT),
        (f"<div>{PAGE}</div>{SIDE}{TALK}", TEXT),
        (f"<div class=ad>{LONG} {LONG} {LONG}</div><article><p>A short one.</p></article>", "A short one."),
        # the names leave nothing
        (f"<div class=sidebar><p>{LONG} 1</p></div><div class=widget><p>{LONG} 2</p></div>", f"{LONG} 1 {LONG} 2"),
    ],
)
def test_wrappers_with_names(body, text):
    assert h.main_text(page(body)) == text


def test_fragments_and_broken_markup():
    assert h.main_text(None) == h.main_text("") == h.main_text("<script>x") == h.main_text("<!-- x") == ""
    assert h.main_text("just text") == "just text"
    assert h.main_text(f"<p>{LONG}<scr") == f"{LONG}"
    assert h.main_text("<p class='x>unclosed quote " + LONG) in ("", LONG, "unclosed quote " + LONG)
    deep = "<div>" * 3000 + LONG + "</div>" * 3000
    assert h.main_text(deep) == LONG
    many = "<article>" + "".join(f"<p>{LONG} {i}</p>" for i in range(20_000)) + "</article>"
    assert h.main_text(many) == " ".join(f"{LONG} {i}" for i in range(20_000))


def test_table(spark, sf_dir):
    rows = h.op6(spark, sf_dir).collect()
    html = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    assert len(rows) == len(html)
    for r in rows:
        own = re.search("<article>(.*?)</article>", html[r.page_id], re.S)[1]
        own = re.sub("<[^>]+>", " ", re.sub("</?(b|i|a)>", "", own))
        assert r.text == " ".join(unescape(own).split()) and r.n_chars == len(r.text)


def test_edges(spark):
    df = spark.createDataFrame([(1, None, None, "x"), (1, None, None, "x"), (None, "u", "<p>a", "y")], "page_id long, url string, html string, text string")
    assert sorted(map(tuple, h.extract(df).collect()), key=str) == sorted([(1, None, None, "", 0)] * 2 + [(None, "u", "<p>a", "a", 1)], key=str)
    assert h.extract(df.limit(0)).count() == 0


def test_ids_inside_the_article_are_anchors():
    para = "<p>%s, with some words, and more of them, so that it counts as a paragraph of text.</p>"
    page = "<html><body><nav>Home</nav><article><h1 id='notice'>Title</h1>" + "".join(para % f"Part {i}" for i in range(6))
    page += "<h2 id='how-to-share-memory'>Sharing</h2><p id='privacy-comment'>Kept words.</p><section id='discussion'><h2>Discussion</h2>" + para % "We discuss" + "</section>"
    page += "<section id='related'><a href=1>One other page</a> <a href=2>Another page</a></section>"
    page += "<section id='comments'><p>A reader wrote this here.</p></section><div class='notice'>Some notice.</div><div id='ad-1'>Buy this now.</div>"
    page += "<section class='discussion'><p>Readers talk.</p></section></article></body></html>"
    text = h.main_text(page)
    for kept in ("Title", "Sharing", "Kept words.", "Discussion", "We discuss", "Part 5"):
        assert kept in text
    for gone in ("Home", "other page", "reader wrote", "Some notice", "Buy this", "Readers talk"):
        assert gone not in text


def test_deep_nesting():
    n = 20_000
    assert h.main_text("<div>" * n + "<p>Words, at the bottom of it, of a paragraph.</p>" + "</div>" * n) == "Words, at the bottom of it, of a paragraph."


TEXT = "Some words of the article, which go on for a while, as they do, and then come to an end. " * 3


def inside(part):
    return h.main_text(f"<html><body><article><h1>Title</h1><p>{TEXT}</p>{part}<p>{TEXT}</p></article></body></html>")


def test_names_inside_the_article_that_say_nothing_of_a_role():
    for part in (
        "<div class=section id=discussion><h2>Discussion</h2><p>We found it so.</p></div>",
        "<div id=privacy-in-law><p>We found it so.</p></div>",
        "<section class=discussion><h2>Discussion</h2><p>We found it so.</p></section>",
        "<section id=comments-on-the-method><p>We found it so.</p></section>",
        "<h2 class=share-heading>We found it so.</h2>",
        "<div class=response-curve><p>We found it so.</p></div>",
        "<p class=has-menu-font>We found it so.</p>",
        "<table class=promo-codes><tr><td>We found it so.</td></tr></table>",
        "<div class='notice-of-motion'><p>We found it so.</p></div>",
        "<section id=feedback><p>We found it so.</p></section>",
    ):
        assert "We found it so." in inside(part), part
    assert "x = 2" in inside("<p>If <math><mi>x</mi> <mo>=</mo> <mn>2</mn><annotation encoding='application/x-tex'>\\tex</annotation></math> then</p>")
    assert "tex" not in inside("<math><mi>x</mi><annotation>\\tex</annotation></math>")


def test_what_is_no_article_goes_from_inside_it():
    for part in (
        "<div class=ad>Gone it is</div>",
        "<div class='ad-box top'>Gone it is</div>",
        "<div class=adSlot>Gone it is</div>",
        "<div id=cookie-notice>Gone it is</div>",
        "<aside>Gone it is</aside>",
        "<div class=share-buttons>Gone it is</div>",
        "<div class='related posts'><a href=x>Gone it is</a></div>",
        "<section id=comments><h2>Comments</h2><p>Gone it is</p></section>",
        "<div class=comment-list><p>Gone it is</p></div>",
        "<section class=discussion><div class=comment><p>Gone it is</p></div></section>",
        "<div id=responses><p>Gone it is</p><form><input></form></div>",
        "<section id=discussion><a href=x>Gone it is</a></section>",
        "<form><p>Gone it is</p></form>",
        "<div class=newsletter-signup>Gone it is</div>",
        "<div class=sponsored>Gone it is</div>",
    ):
        assert "Gone it is" not in inside(part) and TEXT.strip() in inside(part), part
