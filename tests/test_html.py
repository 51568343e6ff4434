import time
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from parcelflow.functions.html import html_rows
from parcelflow.operators.checklist import number_options
from parcelflow.sources.pages import (
    CITY_OPTIONS, OPTION_HEADERS, listing_rows, migration_cells, option_labels,
)
from parcelflow.operators.stats import migration_rows
from tests.fixtures import listing_page, listing_row, migration_page, options_page


def parse_rows(spark, html, selector, cell):
    df = spark.createDataFrame([(html,)], "html string").select(html_rows("html", selector, cell).alias("r"))
    return [r.asDict() for r in df.first().r]


def pages_df(spark, html_by_page):
    rows = [(i, "臺北市", "大安區", 1, i + 1, h) for i, h in enumerate(html_by_page)]
    return spark.createDataFrame(
        rows, "page_id long, city_name string, district_name string, batch_id int, page int, html string")


def test_parser_hidden_and_implied_closes(spark):
    html = "<ul><li>a<li>b<span hidden>zz</span></ul><table><tr><td>1<td>2<tr><td>3</table>"
    assert [r["cells"] for r in parse_rows(spark, html, "li", None)] == [["a"], ["b"]]
    assert [r["cells"] for r in parse_rows(spark, html, "table tr", "td")] == [["1", "2"], ["3"]]


def test_parser_script_text_ignored(spark):
    html = '<script>var t="</p><li>no</li>";</script><ul><li>yes</li></ul>'
    assert [r["cells"] for r in parse_rows(spark, html, "li", None)] == [["yes"]]


def test_listing_rows(spark):
    page = listing_page([
        listing_row("台北市大安區Ａ路１號", parking=True, icon="bt06_br"),
        listing_row("B路2號", icon="bt99_br", type_text="他"),
        listing_row("C路3號", icon="bt99_br", type_text=""),
        listing_row("D路4號", icon=None, type_text="他", target="  "),
        "<tr><td>查無資料</td></tr>",
    ])
    out = listing_rows(pages_df(spark, [page])).orderBy("pos").collect()
    assert len(out) == 5
    first = out[0]
    assert first.address == "台北市大安區A路1號"
    assert first.community == "社區A"
    assert first.total_price_10k == "1,250車"
    assert first.total_tsubo == "30.5"
    assert first.type == "華"
    assert first.transaction_target == "房地(土地+建物)"
    assert first.car_parking_price_10k == "無"
    assert first.note == "無"
    assert first.n_cells == 19
    assert [r.type for r in out[1:4]] == ["他", "無", "他"]
    assert out[3].transaction_target == "無"
    assert out[4].n_cells == 1 and out[4].community is None


def test_migration_rows_min_cells(spark):
    page = migration_page([[" 臺 北 市 ", "1,000", "1,100"], ["合計"], ["新北市", "5", "6", "x"]])
    df = spark.createDataFrame([("move_in", "113", "1", page)],
                               "metric string, roc_year string, roc_month string, html string")
    out = migration_rows(migration_cells(df)).orderBy("pos").collect()
    assert [(r.city_district_name, r.male, r.female) for r in out] == [
        ("臺北市", "1,000", "1,100"), ("新北市", "5", "6")]


def test_option_enumeration(spark):
    df = spark.createDataFrame([(0, options_page(["縣市", "臺北市", "新北市"]))], "site int, html string")
    labels = option_labels(df, CITY_OPTIONS)
    numbered = number_options(labels, ["site", "pos"], exclude={"label": OPTION_HEADERS})
    assert [(r.record_id, r.label) for r in numbered.orderBy("record_id").collect()] == [
        (1, "臺北市"), (2, "新北市")]


def test_parser_implied_tbody_and_row(spark):
    html = "<table id='datatable'><tr><th>h</th></tr><tr><td>a</td><td>b</td></tr></table>"
    assert [r["cells"] for r in parse_rows(spark, html, "#datatable tbody tr", "td")] == [[], ["a", "b"]]
    html = "<table id='t'><thead><tr><th>h</tr></thead><td>x<td>y</table>"
    assert [r["cells"] for r in parse_rows(spark, html, "#t tbody tr", "td")] == [["x", "y"]]


def test_district_options(spark):
    from parcelflow.sources.pages import district_options
    from tests.fixtures import options_page
    city = spark.createDataFrame([(options_page(["縣市", "臺北市", "新北市"]),)], "html string")
    towns = spark.createDataFrame([
        ("新北市", "<select id='p_town'><option>請選擇</option><option>板橋區</option></select>"),
        ("臺北市", "<select id='p_town'><option>請選擇</option><option>中正區</option>"
                  "<option>大安區</option></select>")], "city string, html string")
    got = [tuple(r) for r in district_options(city, towns).orderBy("record_id").collect()]
    assert got == [(1, "臺北市", "中正區"), (2, "臺北市", "大安區"), (3, "新北市", "板橋區")]


def test_hidden_icon_still_found_hidden_text_dropped(spark):
    html = ('<table><tbody id="b"><tr><td>9<span class="btP_br" style="display:none">x</span></td>'
            '</tr></tbody></table>')
    (row,) = parse_rows(spark, html, "#b tr", "td")
    assert row["cells"] == ["9"] and row["spans"] == [["btP_br"]]


def test_cell_text_collapsed_like_rendered_text(spark):
    html = ('<table><tbody id="b"><tr><td>  1,250\n   萬 <b>x</b>  y </td>'
            '<td>a<br> b<div>c</div>d</td><td>\u3000x\u00a0 y</td></tr></tbody></table>')
    (row,) = parse_rows(spark, html, "#b tr", "td")
    assert row["cells"] == [" 1,250 萬 x y ", "a\nb\nc\nd", "\u3000x\u00a0 y"]


def test_result_lines_to_batches(spark):
    from parcelflow.operators.plan import crawl_batches
    from parcelflow.sources.pages import result_lines
    pages = spark.createDataFrame([("大安區", listing_page([listing_row("A")] * 3)), ("信義區", "<p>載入中</p>")],
                                  "district_name string, html string")
    lines = result_lines(pages)
    assert {r.district_name: r.text for r in lines.collect()} == {"大安區": "查詢結果：3 筆", "信義區": None}
    assert [(r.district_name, r.end_page_num) for r in crawl_batches(lines).collect()] == [("大安區", 1)]


AWKWARD = [
    ('<script>if (a<b" && c>d) x="</p>";</script><ul><li>one<li>two &amp; more</ul>', "li", [["one"], ["two & more"]]),
    ("<!-- <li>no</li> --><ul><li a='1' b=\"x>y\" hidden>h</li><li>v<br/>w</li></ul>", "ul li", [[""], ["v\nw"]]),
    ("<ul><li>unclosed <b>bold<li>next &lt;tag&gt; &#39;q&#39; &#x4E2D;</ul><li>after", "li",
     [["unclosed bold"], ["next <tag> 'q' 中"], ["after"]]),
    ("<ul><li>unclosed <b>bold<li>next</ul><li>after", "ul li", [["unclosed bold"], ["next"]]),
    ("<UL><LI CLASS='x'>Up</LI></UL><ul><li>a < b</li></ul><!doctype x><?pi?>", "ul li", [["Up"], ["a < b"]]),
    ("<textarea><li>t</li></textarea>", "li", []),  # a textarea holds text, not elements
    ("<template><li>t</li></template><title><li></title>", "li", []),
    ("<li>a&nosuch;b &amp c &copy;&hellip;</li>", "li", [["a&nosuch;b &amp c \u00a9\u2026"]]),
    ("<li style='x:1; DISPLAY : none'>a</li><li>b<i style=display:none>c</i>d<br hidden>e</li>", "li", [[""], ["bde"]]),
    ("<li class='hidden'>a</li><li title=\"hidden\">b</li><li data-hidden=1>c</li>", "li", [["a"], ["b"], ["c"]]),
    ("\x01li\x02\x03no<li>y\x03es</li>", "li", [["yes"]]),  # control characters are no markup
    ("", "li", []), ("no markup < at all > here", "li", []), ("<li", "li", []), ("<li>", "li", [[""]]),
    ("<table><tr><td>1<td>2</table>", "table tbody tr", [["1", "2"]]),
    ("<table><tbody><tr><td>1<tr><td>2<tbody><tr><td>3</table>", "table tbody tr", [["1"], ["2"], ["3"]]),
    ("<table id=t><tr><td hidden>1</td><td>2</td></tr></table><table><tr><td>x</table>", "#t tr", [["", "2"]]),
    ("<div id=tt></div><p id='t'>not</p><div data-id='t'>no</div>", "#t", [["not"]]),
]


@pytest.mark.parametrize("html,selector,cells", AWKWARD)
def test_awkward_markup(spark, html, selector, cells):
    cell = "td" if selector.endswith("tr") else None
    assert [r["cells"] for r in parse_rows(spark, html, selector, cell)] == cells


def test_null_pages_give_no_rows(spark):
    df = spark.createDataFrame([(None,)], "html string")
    assert df.select(html_rows("html", "li", None).alias("r")).first().r is None
    with pytest.raises(ValueError):
        html_rows("html", "li:first", None)


def test_spans_and_links(spark):
    html = ("<li><span class='a b'>x</span><span>y</span><span title=\"class='no'\" class=c></span>"
            "<a name=n>t</a><a class='k' href='/p?a=1&amp;b=2'>u</a><a href='/second'></a></li><li><a href=''>e</a></li>")
    one, two = parse_rows(spark, html, "li", None)
    assert one["spans"] == [["a b", "", "c"]] and one["hrefs"] == ["/p?a=1&b=2"] and one["cells"] == ["xytu"]
    assert two["hrefs"] == [""]


class Flat(HTMLParser):
    """Texts of all elements of one tag, by the standard library's parser."""

    def __init__(self, tag):
        super().__init__()
        self.tag, self.inside, self.out = tag, False, []

    def handle_starttag(self, tag, attrs):
        if tag == self.tag:
            self.inside = True
            self.out.append("")

    def handle_endtag(self, tag):
        if tag == self.tag:
            self.inside = False

    def handle_data(self, data):
        if self.inside:
            self.out[-1] += data


@pytest.mark.parametrize("tag", ["li", "h1"])
def test_pages_as_the_standard_library_reads_them(spark, tag):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "html")
    got = {r.page_id: [x[0] for x in r.c] for r in pages.select(
        "page_id", F.transform(html_rows("html", tag, None), lambda r: r.cells).alias("c")).collect()}
    for r in pages.collect():
        flat = Flat(tag)
        flat.feed(r.html)
        flat.close()
        assert got[r.page_id] == [" ".join(x.split(" ")) for x in flat.out]


@pytest.mark.parametrize("broken", ["<x '", "</q>", "<!--", "<script", "<li ", "<td>", "<a href=", "&#", "<li><b><", "<tr hidden ",
                                    "<p style='", '<i a="b'])
def test_broken_markup_costs_no_more(spark, broken):
    """Ten times the broken text takes about ten times as long, and no stack."""
    def seconds(n):
        df = spark.createDataFrame([(broken * (n // len(broken)),)], "html string")
        start = time.time()
        for selector in ("#a tbody tr", "li"):
            df.select(html_rows("html", selector)).collect()
        return time.time() - start
    seconds(1000)
    assert seconds(400_000) < 10 * seconds(40_000) + 5


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([("",)], "html string").select(html_rows("html", "#t tbody tr"))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
