from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gleanery.operators import webtables as W
from gleanery.plans.migration import migrate_pages
from tests.conftest import AS_OF, by

PAGE = """<html><body>
<table class="main"><thead><tr><th>Name</th><th>Url</th><th>Notes</th></tr></thead>
<tbody>
<tr><td>Early</td><td><a href="https://github.com/o/early">x</a></td><td>12 stars</td></tr>
<tr class="c"><td colspan="3"><strong>OFFICIAL / TRYGHOST THEMES</strong></td></tr>
<TR>
  <TD> <b>Casper</b> &amp; Co </TD>
  <TD><a class="l" href=' https://github.com/TryGhost/Casper/tree/main '>link</a></TD>
  <TD>Default theme with dark mode; 2,600 stars; newsletter ready</TD>
</TR>
<tr><td>two</td><td>cells</td></tr>
<tr><td>TOOLS &amp; RESOURCES</td></tr>
<tr><td>NoLink</td><td>none</td><td>x</td></tr>
<tr><td>Elsewhere</td><td><a href="https://gitlab.com/a/b">x</a></td><td>x</td></tr>
<tr><td></td><td><a href="https://github.com/a/b">x</a></td><td>x</td></tr>
<tr><td>Scan</td><td><a href="https://github.com/o/scan">x</a></td><td>2.6k stars</td><td>more</td></tr>
</tbody></table>
<table><tbody><tr><td>Second</td><td><a href="https://github.com/o/second">x</a></td><td>99 stars</td></tr></tbody></table>
</body></html>"""


@pytest.fixture(scope="module")
def migrated(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, "<p>no table</p>")], "page_id int, html string")
    return migrate_pages(pages, AS_OF)


def test_items(migrated):
    found = by(migrated.items, "id")
    assert set(found) == {"o/early", "TryGhost/Casper", "o/scan"}
    assert found["o/early"]["category"] == "Other"
    casper = found["TryGhost/Casper"]
    assert (casper["name"], casper["category"], casper["stars"]) == ("Casper & Co", "Official", 2600)
    assert casper["url"] == "https://github.com/TryGhost/Casper/tree/main"
    assert casper["description"] == "Default theme with dark mode"
    assert casper["tags"] == ["ghost-theme", "official", "dark-mode", "newsletter"]
    assert (casper["confidence"], casper["score"]) == ("high", 100)
    assert casper["notes"] == "Default theme with dark mode; newsletter ready"
    scan = found["o/scan"]
    # The letter k is not read: two stars.
    assert (scan["stars"], scan["confidence"], scan["score"], scan["description"], scan["notes"]) == (2, "low", 60, None, None)


def test_warnings(migrated):
    assert {r["message"] for r in migrated.warnings.collect()} == {
        "Skipping row with missing name or URL: NoLink", "Invalid GitHub URL: https://gitlab.com/a/b",
        "Skipping row with missing name or URL: unnamed",
    }


def test_counts_and_order(migrated):
    assert {r["category"]: r["items"] for r in migrated.category_counts.collect()} == {"Other": 1, "Official": 1, "Tool": 1}
    assert [r["category"] for r in migrated.items.collect()] == ["Other", "Official", "Tool"]


@pytest.mark.parametrize(
    ("text", "plain", "thousands"),
    [("1,300 stars", 1300, 1300), ("2.6k stars", 2, 2600), ("7 star", 7, 7), ("none", 0, 0), ("3 K Stars", 3, 3000)],
)
def test_star_counts(spark, text, plain, thousands):
    row = spark.createDataFrame([(text,)], "t string").select(
        W.star_count(F.col("t")).alias("a"), W.star_count(F.col("t"), thousands=True).alias("b")
    ).first()
    assert (row["a"], row["b"]) == (plain, thousands)


@pytest.mark.parametrize(
    ("header", "category"),
    [("official", "Official"), ("From TryGhost", "Official"), ("Resources", "Tool"), ("DEVELOPMENT", "Starter"),
     ("Popular themes", "Theme"), ("", "Theme")],
)
def test_headers(spark, header, category):
    row = spark.createDataFrame([(header,)], "h string").select(W.category_from_header(F.col("h")).alias("c")).first()
    assert row["c"] == category


@pytest.mark.parametrize(
    ("notes", "want"),
    [("; 12 stars; good one ,", "good one"), ("ab", None), ("", None), (None, None), ("1.2k stars, nice theme", "nice theme")],
)
def test_notes(spark, notes, want):
    row = spark.createDataFrame([(notes,)], "n string").select(W.clean_notes(F.col("n")).alias("c")).first()
    assert row["c"] == want


@pytest.mark.parametrize(
    "html",
    [
        "<table><tr><td>a<td>b<td>c<tr><td>d</table>",
        "<!-- <table><tr><td>no</td></tr></table> --><table><thead><tr><td>head</td></tr></thead>"
        "<tr><td>a</td><td>b</td><td>c</td></tr><tr><td>d</td></tr><tfoot><tr><td>f</td></tr></tfoot></table>",
        "<script>'<table><tr><td>x'</script><TABLE><TBODY><TR><TH>h</TH><TD>a</TD><TD>b</TD><TD>c</TD></TR></TBODY>"
        "<TBODY><TR><TD>d</TD></TR></TBODY></TABLE>",
        "<table><tbody><tr><td>a</td><td>b</td><td>c</td></tr><tr><td>d",
    ],
)
def test_loose_html(spark, html):
    rows = W.table_rows(spark.createDataFrame([(1, html)], "page_id int, html string")).orderBy("row_pos").collect()
    assert [list(r["cells"]) for r in rows] == [["a", "b", "c"], ["d"]]


def test_rows_are_read_and_filled_without_a_shuffle(spark):
    pages = spark.createDataFrame([(1, PAGE)], "page_id int, html string")
    for read in (W.table_rows(pages), W.extract_rows(pages), W.row_items(W.extract_rows(pages), AS_OF), W.page_links(pages)):
        plan = read._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Python" not in plan


def rows_of(spark, html):
    found = W.table_rows(spark.createDataFrame([(1, html)], "page_id int, html string")).orderBy("row_pos")
    return [r[0] for r in found.select(F.transform("cells", W.cell_text)).collect()]


@pytest.mark.parametrize(
    ("html", "rows"),
    [
        ('<table><tr><td title="a > b <td>">a<td data-x=\'<tr>\'>b</table>', [["a", "b"]]),
        ("<table><tr><td>a<table><thead><tr><th>h<td>i</thead><tr><td>b<td>c</table>d<td>e<tr><td>f</table>",
         [["ahibcd", "i", "b", "c", "e"], ["i"], ["b", "c"], ["f"]]),
        ("<table><thead><tr><td>a<table><tr><td>b</table></thead><tr><td>c</table>", [["b"], ["c"]]),
        ("<table><tr><td>a</tr><table><tr><td>b</table>", [["a"]]),
        ("<table><td>a<td>b<tbody><tr></tbody><td>c</table>", [["a", "b"], [], ["c"]]),
        ("<table><caption>x <table><tr><td>y</table></caption><tr><td>a</table>", [["y"], ["a"]]),
        ("<table><tr><td>a</th>b</tr></td>c</table>", [["ab"]]),
        ("<tr><td>x</td></tr><table></table><table><tr><td>y</table>", []),
        ("<table><tr><td>a <!-- <td> --> b<script>'<td>'</script>", [["a  b'"  + "'"]]),
        ("<TABLE><TR><TD>a<br/>b<td/>c < d <tr", [["ab", "c < d"]]),
    ],
)
def test_rows_as_a_browser_reads_them(spark, html, rows):
    assert rows_of(spark, html) == rows


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("Tom&#8217;s &#x2014; &#X41;&#66", "Tom’s — AB"), ("&amp;lt; &lt;b&gt; &quot;&apos;", "&lt; <b> \"'"),
        ("AT&T &unknown; & &; &amp", "AT&T &unknown; & &; &"), ("&#150;&#128;", "–€"), ("&#0;&#xD800;&#x110000;", "\ufffd" * 3),
        ("x&nbsp;y&copy;", "x y©"), ("&ltx &copy=1", "&ltx &copy=1"), ("&#128512;", "\U0001f600"), ("1 < 2 > 0", "1 < 2 > 0"),
    ],
)
def test_character_references(spark, html, text):
    assert spark.createDataFrame([(html,)], "h string").select(W.cell_text(F.col("h"))).first()[0] == text


@pytest.mark.parametrize(
    ("cell", "url"),
    [
        ("<a href=https://x.org/a?b=c>l</a>", "https://x.org/a?b=c"), ("<a title=' href=no>' HREF = ' y&amp;z '>", "y&z"),
        ("<a name=x><a href=y>", None), ("<abbr href=z><a data-href=q href='a>b'>", "a>b"), ("<a class=x/href=y>", None),
        ('<a class="x"href=y>', "y"), ("<a href>", None), ("<!-- <a href=x> -->", None), ("none", None), ("<a/href=y>", "y"),
    ],
)
def test_first_link(spark, cell, url):
    assert spark.createDataFrame([(cell,)], "h string").select(W.link_target(F.col("h"))).first()[0] == url


def test_every_link_of_a_page(spark):
    page = "<p><a href=one>1</a><li><a class=x href='two&amp;'>2</a><a name=none><script>'<a href=no>'</script><area href=no><A HREF=\"\">"
    found = W.page_links(spark.createDataFrame([(1, page), (2, None)], "page_id int, html string")).orderBy("row_pos").collect()
    assert [tuple(r) for r in found] == [(1, 0, "one"), (1, 1, "two&"), (1, 2, "")]


def test_long_tables_take_time_in_proportion(spark):
    page = "<table>" + "".join(f'<tr><td title=">">{i}</td><td>b<td>c</tr>' for i in range(5000))
    rows = W.extract_rows(spark.createDataFrame([(1, page)], "page_id int, html string"))
    assert rows.agg(F.count(F.lit(1)), F.max("row_pos")).first() == (5000, 4999)


def test_categories_are_filled_within_each_page(spark):
    page = "<table><tr><td>a<td>b<td>c<tr><td>tools<tr><td>d<td>e<tr><td>x<tr><td>official<tr><td>f<td>g<td>h</table>"
    paged = W.page_rows(spark.createDataFrame([(1, page), (2, "<p>")], "page_id int, html string"))
    found = W.fill_category_down(paged).orderBy("row_pos").collect()
    assert [(r.row_pos, r.category) for r in found] == [(0, "Other"), (1, "Tool"), (2, "Tool"), (3, "Theme"), (4, "Official"), (5, "Official")]


def test_a_page_is_read_once_for_its_rows(spark):
    """A filter on the rows, which Spark adds where a column is unfolded, would work them out again."""
    pages = spark.createDataFrame([(1, "<table><tr><td>a<td>b</table>"), (2, "no table"), (3, None)], "page_id int, html string")
    rows = W.table_rows(pages.select("page_id", "html"))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1 and "Filter" not in plan
    assert [(r.page_id, r.row_pos, r.cells) for r in rows.collect()] == [(1, 0, ["a", "b"])]
