from __future__ import annotations

import pytest

from firmscout.llm.html import extract, main_text

ARTICLE = "<h1>Title &amp; more</h1><p>First paragraph, long enough to count, with commas.</p><p>Second  one,\n spread\tout &lt;here&gt;.</p>"
TEXT = "Title & more\nFirst paragraph, long enough to count, with commas.\nSecond one, spread out <here>."
NOISE = (
    "<nav><ul><li><a href='/'>Home, sweet home, and more links than text</a></li></ul></nav>",
    "<header><h1>The Site</h1></header>",
    "<div class='cookie-notice'><p>We use cookies, as all sites do, to serve you well.</p></div>",
    "<aside><p>Read this too, it is quite long, and has commas, many.</p></aside>",
    "<div id='sidebar'><p>Read this too, it is quite long, and has commas, many.</p></div>",
    "<form><p>Subscribe now, it is free, and we do not send spam.</p><input></form>",
    "<div class='ad'>Buy, buy, buy, this thing that nobody needs at all.</div>",
    "<script>var x = '<p>not, a, text</p>';</script><style>p{}</style><!-- <p>nor, this</p> -->",
    "<section class='comments'><h2>Comments</h2><p>I liked this, really, very much, thank you.</p></section>",
    "<div style='display:none'><p>Hidden words, that nobody sees, are here.</p></div>",
    "<footer>&copy; all of us</footer>",
)


@pytest.mark.parametrize("frame", ["<article>{}</article>", "<main>{}</main>", "<div class='content'>{}</div>", "<div><div>{}</div></div>"])
def test_article_among_boilerplate(frame):
    page = "<!DOCTYPE html><html><head><title>T</title></head><body>" + "".join(NOISE[:5]) + frame.format(ARTICLE) + "".join(NOISE[5:]) + "</body></html>"
    assert main_text(page) == TEXT


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("   \n", ""),
        ("just text", "just text"),
        ("<nav><a>only a menu</a></nav>", ""),
        ("<p><b>unclosed<br><p>next", "unclosed\nnext"),
        ("<article><p>a<br>b</p><ul><li>c<li>d</ul><table><tr><td>e<td>f</table></article>", "a b\nc\nd\ne\nf"),
        ("<article>&#233;&eacute;&amp;amp; &nbsp; x</article>", "éé&amp; x"),
        ("<article><p>kept<script>lost", "kept"),
        ("<article><p>kept</p><p class='x", "kept"),
        ("<article><p>1 < 2 and 3 > 2</p></article>", "1 < 2 and 3 > 2"),
        ("<ARTICLE><P>Upper</P></ARTICLE>", "Upper"),
        ("<article><header><h1>Own head</h1></header><p>Body.</p></article>", "Own head\nBody."),
        ("</div></p></article>loose", "loose"),
        ('<article title="a > b"><p>quoted</p></article>', "quoted"),
        ("<article><h1>T</h1><div class='comment'><p>No, no, no, this is one reader's view.</p></div></article>", "T"),
    ],
)
def test_small_pages(page, text):
    assert main_text(page) == text


def test_sibling_paragraphs_stay():
    page = "<body><div><p>A long paragraph, with commas, in the first of two parts.</p><p>And another one, as long, with more, to say.</p></div><div><p>The second part, with commas, is as long as the first.</p><p>It too has two paragraphs, each long, each with commas.</p></div></body>"
    assert main_text(page).count("\n") == 3


def test_long_and_hostile_pages():
    many = "<article>" + "<p>Some words, here and there, again.</p>" * 20_000 + "</article>"
    assert main_text(many).count("\n") == 19_999
    assert main_text("<div>" * 50_000 + "deep") == "deep"
    assert main_text("<a \"" * 50_000) == ""
    assert main_text("x" + "<" * 100_000).startswith("x")


@pytest.mark.parametrize(
    "frame",
    [
        "<div id=page class='layout has-sidebar'><article>{}</article></div>",
        "<div id=page class='layout has-sidebar'><div class='text'>{}</div></div>",
        "<main class='no-comments'>{}</main>",
        "<main class='sidebar'>{}</main>",
        "<article class='post comments-open'>{}</article>",
        "<article class='post promoted sponsored'>{}</article>",
        "<div class='content social-enabled'>{}</div>",
        "<main><div class='nav-fixed'><article id='withComments'>{}</article></div></main>",
        "<div class='modal overlay'><article>{}</article></div>",
    ],
)
def test_marks_at_what_holds_the_article(frame):
    page = "<html><body>" + "".join(NOISE[:5]) + frame.format(ARTICLE) + "".join(NOISE[5:]) + "</body></html>"
    assert main_text(page) == TEXT


def test_marks_at_other_parts_still_cut():
    reply = "<article class='comment'><p>No, no, no, this is a reader's view, and it is long, longer than the text.</p></article>"
    others = f"<div id='comments' class='comments-area'>{reply * 5}</div><div class='related-posts'><article>{ARTICLE}</article></div>"
    assert main_text(f"<body><article class='has-thumb comments-open'>{ARTICLE}</article>{others}</body>") == TEXT
    assert main_text(f"<body><div class='text'>{ARTICLE}</div><div class='share-this'><p>Share it, with all, and everyone.</p></div></body>") == TEXT
    assert main_text("<body><div class='ad'><p>Buy, buy, buy, this thing that nobody needs.</p></div></body>") == ""


@pytest.mark.parametrize("frame", ["<article>{}</article>", "<main>{}</main>", "<main><div><article>{}</article></div></main>"])
def test_short_parts_beside_a_long_section_stay(frame):
    long = "".join(f"<p>Paragraph {i}, of some length, with commas, and words, in it.</p>" for i in range(40))
    short = "<h2>End</h2><p>So.</p><ul><li>one<li>two</ul><table><tr><td>a<td>b</table><blockquote>Q.</blockquote><section><p>Fin.</p></section>"
    page = "<body>" + "".join(NOISE[:5]) + frame.format(f"<h1>T</h1><section>{long}</section>{short}") + "".join(NOISE[5:]) + "</body>"
    lines = main_text(page).split("\n")
    assert lines == ["T", *(f"Paragraph {i}, of some length, with commas, and words, in it." for i in range(40)), *"End So. one two a b Q. Fin.".split()]


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<article><p>We </3 ads</p><p>Next</p></article>", "We\nNext"),
        ("<article><p>a</>b</p><p>c</p></article>", "ab\nc"),
        ("<article><p don't>kept</p><p>Next</p></article>", "kept\nNext"),
        ("<article><p don't>kept</p><p>It isn't lost</p></article>", "kept\nIt isn't lost"),
        ("<article><p 5\">kept</p><p class=a\"b>Next</p></article>", "kept\nNext"),
        ("<article><p title='it>kept</p><p>Next</p></article>", "kept\nNext"),
        ("<article><p title = 'a > b' class=\"x>y\">kept</p></article>", "kept"),
        ("<article><p title='hidden>kept</p><p>Next</p></article>", "kept\nNext"),
    ],
)
def test_broken_tags(page, text):
    assert main_text(page) == text


def test_frame(spark):
    rows = [(1, "u", f"<article>{ARTICLE}</article>", "t"), (None, None, None, "t"), (2, "v", "", "t"), (2, "v", "", "t")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(map(tuple, extract(df).collect()), key=repr)
    assert got == sorted([(1, "u", TEXT, len(TEXT)), (None, None, "", 0), (2, "v", "", 0), (2, "v", "", 0)], key=repr)
    assert extract(df.limit(0)).collect() == []
