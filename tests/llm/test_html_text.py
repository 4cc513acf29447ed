from __future__ import annotations

import re
from html.parser import HTMLParser

import pytest
from hypothesis import given
from hypothesis import strategies as st

from clickloom.llm.html_text import VOID, extract, visible_text

CASES = {
    "<p>one<p>two": "one\n\ntwo",
    "a<br>b": "a\nb",
    "<ul><li>a<li>b</ul>": "- a\n- b",
    "<ol><li>a<ul><li>x</ul><li>b</ol>": "1. a\n   - x\n2. b",
    "<table><tr><td>aa<td>b<tr><td>c<td>dd</table>": "aa  b\nc   dd",
    "<table><tr><td colspan=2>wide<td>z<tr><td>a<td>b<td>c</table>": "wide  z\na  b  c",
    "<head><title>t</title><body>x": "x",
    "<div hidden>h</div>y<span style='DISPLAY : none'>z</span>": "y",
    "<script>a<b</script>c": "c",
    "<pre> a\n  b </pre>": " a\n  b",
    "a &amp; b &lt;c&gt;": "a & b <c>",
    "1 < 2": "1 < 2",
    "x<!-- y -->z": "xz",
    "</div>a</p>b": "a\nb",
    "<b>bold<p>in</b> after": "bold\n\nin after",
    "<table><tr><td>a<p>b</table>c": "a\n\nb\n\nc",
    "": "",
    "<": "<",
    "<a": "",
    "<dl><dt>t<dd>d</dl>": "t\n  d",
}


@pytest.mark.parametrize("page", CASES)
def test_layout(page):
    assert visible_text(page) == CASES[page]


class _Plain(HTMLParser):
    """All text outside scripts and styles."""

    def __init__(self):
        super().__init__()
        self.parts, self.inside = [], 0

    def handle_starttag(self, tag, attrs):
        self.inside += tag in ("script", "style", "head")
        self.parts.append(" ")

    def handle_endtag(self, tag):
        self.inside -= tag in ("script", "style", "head")
        self.parts.append(" ")

    def handle_data(self, data):
        if not self.inside:
            self.parts.append(data)


def test_words_of_real_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = {r.page_id: r.html for r in pages.select("page_id", "html").collect()}
    got = {r.page_id: r.text for r in extract(pages).collect()}
    assert got.keys() == rows.keys()
    marks = re.compile(r"^ *(?:- |\d+\. )", re.M)
    for page, source in rows.items():
        plain = _Plain()
        plain.feed(source)
        plain.close()
        squeeze = lambda s: re.sub(r"\s+", "", s)
        assert squeeze(marks.sub("", got[page])) == squeeze(marks.sub("", "".join(plain.parts))), page


@given(st.lists(st.sampled_from(["<p>", "</p>", "<li>", "<ul>", "</ul>", "<td>", "<tr>", "<table>", "</table>", "<b>", "</b>", "<div>", "</div>", "w ", "< "]), max_size=25))
def test_no_text_is_lost_however_tags_nest(parts):
    text = visible_text("".join(parts))
    assert text.count("w") == parts.count("w ")


def test_deep_and_long_pages():
    assert visible_text("<div>" * 5000 + "x") == "x"
    assert len(visible_text("<p>word " * 20000).split()) == 20000


def test_operator(spark):
    rows = [(1, None), (2, ""), (None, "<p>x"), (3, "<p>a<p>b"), (3, "<p>a<p>b")]
    df = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, html string, text string")
    got = sorted((tuple(r) for r in extract(df).collect()), key=repr)
    assert got == sorted([(1, ""), (2, ""), (None, "x"), (3, "a\n\nb"), (3, "a\n\nb")], key=repr)
    assert extract(df.limit(0)).collect() == []
    assert "br" in VOID


SHOWN = {
    "<tr><td>aa<td>b<tr><td>c": "aa  b\nc",
    "<table><tr><td>a</table><tr><td>b<td>c</tr></table>d": "a\n\nb  c\nd",
    "<div><tr><th>a</tr></div>b": "a\nb",
    "x <math><mi>a</mi><mo>=</mo><mn>2</mn><annotation>TeX</annotation></math> y": "x a=2 y",
    "<svg><title>t</title><path d='1'/><g>n<text x=1>one</text><text>two</text></g></svg>after": "one two after",
    "<svg><title/><defs><text>no</text></defs><text>yes</text></svg>": "yes",
    "<svg hidden><text>no</text></svg>x": "x",
    "<svg><path><p>out": "out",
    "<svg><foreignObject><div>in</div></foreignObject></svg>after": "in\nafter",
}


@pytest.mark.parametrize("page", SHOWN)
def test_rows_without_a_table_and_labels_are_shown(page):
    assert visible_text(page) == SHOWN[page]


MENDED = {
    "a<!-->b<p>c": "ab\n\nc",
    "a<!--->b": "ab",
    "a<!-- x --!>b<p>d</p>": "ab\n\nd",
    "a<!-- <b>x</b> -- > --><i>b</i>": "ab",
    "a<!-- never closed <p>b": "a",
    "a</br>b": "a\nb",
    "<pre>\nx\ny</pre>": "x\ny",
    "<pre>\r\nx</pre>": "x",
    "<pre>\n\nx</pre>": "\nx",
    "<ol start=3><li>a<li>b</ol>": "3. a\n4. b",
    "<ol><li>a<li value=5>b<li>c</ol>": "1. a\n5. b\n6. c",
    "<ol start='-1'><li>a<li>b</ol>": "-1. a\n0. b",
    "<ol start=x><li>a</ol>": "1. a",
    "<div style='visibility:hidden'>no<b style='visibility:visible'>yes</b>no</div>x": "yes\nx",
    "<div style='display:none'>no<b style='visibility:visible'>no</b></div>x": "x",
    "<table><tr><td rowspan=2>a<td>b<tr><td>c</table>": "a  b\n   c",
    "<table><tr><td rowspan=0>a<td>b<tr><td>c<tr><td>dd<td>e</table>": "a  b\n   c\n   dd  e",
    "<table><tr><td>aaa<td rowspan=2>b<td>c<tr><td>d<td>e</table>": "aaa  b  c\nd       e",
    "<table><tr><td>one<tr><td>two</table>": "one\ntwo",
}


@pytest.mark.parametrize("page", MENDED)
def test_comments_visibility_numbers_and_rows_down(page):
    assert visible_text(page) == MENDED[page]


def columns_by_hand(grid):
    """A table of one-line cells without spans, by the plain rule."""
    width = [max(len(row[i]) if i < len(row) else 0 for row in grid) for i in range(max(map(len, grid)))]
    return "\n".join("  ".join(c.ljust(w) for c, w in zip(row, width)).rstrip() for row in grid)


@given(st.lists(st.lists(st.text("abc", min_size=1, max_size=9), min_size=2, max_size=5), min_size=1, max_size=6))
def test_tables_equal_plain_padding(grid):
    page = "<table>" + "".join("<tr>" + "".join(f"<td>{c}" for c in row) for row in grid) + "</table>"
    assert visible_text(page) == columns_by_hand(grid)


def test_work_and_output_stay_in_proportion_to_the_page():
    import time

    wide = "<table><tr><td>" + "w" * 20_000 + "<td>x" + "<tr><td>a<td>b" * 120_000 + "</table>"
    lists = "<ul><li>a" * 6_000
    tables = "<table><tr><td>t" * 2_000
    spans = "<table>" + "<tr><td colspan=1000 rowspan=9>a<td>b" * 5_000
    for page in (wide, lists, tables, spans):
        begin = time.process_time()
        text = visible_text(page)
        assert time.process_time() - begin < 6
        assert len(text) < 11 * len(page)
    assert visible_text(lists).count("a") == 6_000 and visible_text(tables).count("t") == 2_000
    assert visible_text(wide).splitlines()[1] == "a" + " " * 101 + "b"


def test_columns_with_the_same_names(spark):
    df = spark.createDataFrame([(1, "<p>a", "x", "y")], "page_id long, html string, _row string, _html string")
    assert [tuple(r) for r in extract(df).collect()] == [(1, "a")]
