"""Main text of pages."""

import html
import re
import time

import numpy as np
import pytest

from ledgerlens.llm import pages
from ledgerlens.llm.queries import op2_html_extraction
from samples import SF  # noqa: F401

TREE = pages.train_tree(*pages.labelled_table())


def test_articles_of_the_given_pages(spark):
    got = {r["page_id"]: r for r in op2_html_extraction(spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    for r in rows:
        article = re.search(r"(?s)<article>(.*?)(</article>|$)", r["html"])[1]
        parts = [re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]*>", " ", p))).strip() for p in re.split("</?(?:p|h1)>", article)]
        assert got[r["page_id"]]["text"] == "\n\n".join(p for p in parts if p)
        assert got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"])
    assert len(got) == len(rows)


def test_parts_around_the_text():
    page = (
        "<body><header><a href=x>Home</a></header><div class='cookie-notice'>We use cookies to give you the best experience.</div><main><article><h1>A &amp; B</h1>"
        "<p>One <a href=y>link</a>&nbsp;here &#233;.<p>Short.<form><label>Name</label><input></form><script>if (a < b) { x('<p>no</p>') }</script>"
        "<section class=comments><p>Great article, I enjoyed reading it.</p></section></article></main><aside>More to read</aside><footer>c</footer>"
    )
    assert pages.main_text(page, TREE) == "A & B\n\nOne link here é.\n\nShort."


def test_page_without_article():
    long = "word " * 60
    page = f"<body><ul><li><a href=1>A</a><li><a href=2>B</a></ul><h1>Title</h1><div><p>{long}</p><p>{long}</p></div><p><a href=3>next</a></p>"
    assert pages.main_text(page, TREE) == "\n\n".join(["Title", long.strip(), long.strip()])


def test_odd_pages(spark):
    rows = [(1, "u", None, "t"), (2, None, "", "t"), (3, "u", "<p", "t"), (4, "u", "no markup at all " * 30, "t"), (5, "u", "<article><p>" + "x " * 200_000, "t"), (6, "u", "<<>>&<b></i>" * 50, "t")]
    out = {r["page_id"]: r for r in pages.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()}
    assert len(out) == 6 and out[1]["text"] == out[2]["text"] == "" and out[5]["n_chars"] == 399_999
    assert pages.extract_pages(spark.createDataFrame(rows[:1], "page_id long, url string, html string, text string").limit(0)).count() == 0


def texts(page):
    return [b.text for b in pages.blocks(page)]


def test_head_without_end_tag():
    long = "word " * 60
    for top in ("<html><head><title>t</title><meta charset=utf-8><body>", "<head><title>t</title><script>x</script>", "<head><noscript><style>a</style><body>", "<html><head><link rel=x><title>t</title><div>"):
        assert pages.main_text(f"{top}<article><h1>Title</h1><p>{long}<p>{long}</article>", TREE) == "\n\n".join(["Title", long.strip(), long.strip()])
    assert texts("<head><title>t</title>Text in no element<p>more") == ["Text in no element", "more"]
    assert texts("<head><title>t</title><meta name=a><noscript>n</noscript></head><p>more") == ["more"]


def test_options_without_end_tag():
    long = "word " * 60
    for part in ("<select><option>A<option>B</select>", "<select><optgroup label=x><option>A<optgroup label=y><option>B</select>", "<datalist id=d><option value=a>A<option>B</datalist>", "<canvas>no canvas</canvas>"):
        assert pages.main_text(f"<body><form>{part}<input></form><article><h1>Title</h1><p>{long}</article>", TREE) == f"Title\n\n{long.strip()}"
    assert texts("<form><select><option>A</form><p>after") == ["after"]


def test_other_end_tags_left_out():
    assert [(b.text, b.outside) for b in pages.blocks("<p class=ad>Buy<div>Text</div><table><tr><td class=ad>Buy<tr><td>Cell</table>")] == [("Buy", True), ("Text", False), ("Buy", True), ("Cell", False)]
    assert texts("<dl><dt hidden>no<dd>yes</dl><table><thead hidden><tr><th>no<tbody><tr><td>yes</table>") == ["yes", "yes"]


def paragraph(words, linked):
    return "<p>" + " ".join(f"<a href=x>w{i}</a>" if i < linked else f"w{i}" for i in range(words)) + "</p>"


@pytest.mark.parametrize("around", ["article", "main", "div"])
def test_linked_prose_stays_at_any_length(around):
    for words in (20, 35, 49, 52, 60, 80, 120, 200):
        for share in (0, 3, 5, 8, 12, 20, 30):
            page = f"<body><nav><a href=1>A</a></nav><ul><li><a href=2>B</a></ul><{around}><h1>Title</h1>{paragraph(words, words * share // 100) * 3}</{around}><footer>f</footer>"
            assert len(pages.main_text(page, TREE).split("\n\n")) == 4, (words, share)


WRAPPERS = ["has-sidebar", "site-content sidebar-right", "content no-comments", "layout with-ads", "col side-by-side", "post-notice", "page search", "entry-content share"]


@pytest.mark.parametrize("name", WRAPPERS)
@pytest.mark.parametrize("around", ["article", "main", "div"])
def test_a_wrappers_class_does_not_empty_the_page(name, around):
    page = f"<body><nav><a href=1>A</a></nav><div class='{name}'><{around}><h1>Title</h1>{paragraph(60, 4) * 2}</{around}></div><footer>f</footer>"
    assert len(pages.main_text(page, TREE).split("\n\n")) == 3


@pytest.mark.parametrize("name", ["sidebar", "sidebar-right", "site-footer", "cookie-notice", "post-notice", "comments", "comment-list", "related-posts", "social share", "ad"])
def test_parts_named_by_class_go(name):
    long = paragraph(40, 1)
    for page in (f"<article><h1>T</h1>{long}<div class='{name}'>{paragraph(30, 0)}</div>{long}</article>", f"<div class='{name}'>{paragraph(30, 0) * 2}</div><div><h1>T</h1>{long * 3}</div>"):
        assert "w29\n" not in pages.main_text(page, TREE) and pages.main_text(page, TREE).startswith("T\n\n")


def test_long_discussions_and_comments_as_articles_go():
    article = f"<article><h1>T</h1>{paragraph(30, 1) * 2}</article>"
    comments = "<section class=comments>" + f"<article>{paragraph(80, 0)}</article>" * 20 + "</section>"
    single = f"<article class=comment>{paragraph(300, 0)}</article>" * 3
    for page in (article + comments, f"<main>{article}{comments}</main>", article + single, f"<form class=layout>{article}</form>{comments}"):
        assert len(pages.main_text(page, TREE).split("\n\n")) == 3


@pytest.mark.parametrize("part", ["<div>", "<b>", "<p><i>", "<b><div>", "<div class=share>", "<div class=comments><article>"])
def test_deep_nesting_takes_linear_time(part):
    for page in (part * 100_000 + "text " * 20, part * 50_000 + "text " * 20 + "</b></div></i></p>" * 50_000):
        began = time.process_time()
        assert len(pages.blocks(page)) == 1
        assert time.process_time() - began < 5


def test_tree_leaves_hold_five_rows():
    x, y = pages.labelled_table()

    def least(tree, rows):
        if len(tree) == 1:
            return len(rows)
        low = x[rows, tree[0]] <= tree[1]
        return min(least(tree[2], rows[low]), least(tree[3], rows[~low]))

    assert least(TREE, np.arange(len(y))) >= 5
