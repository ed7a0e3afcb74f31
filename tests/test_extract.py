from naviscope.operators import extract

ROOT = "http://h"
FAMILIES = """<table class="other"><tr><td>no</td></tr></table>
<table class="x tblfund1"><tr><th>Family</th><th></th><th>Assets</th></tr>%s</table>
<table class="tblfund1"><tr><td>second</td></tr></table>""" % "".join(
    f'\n<tr><td><a href="/amc/F{i}"><b>Fam {i}</b></a></td><td>x</td><td>{i},000.5</td></tr>' for i in range(12)
)
SCHEMES = """<div class="boxBg MT10 FL"><div><table><tr><th>Scheme</th></tr>
<tr><td><a href="/s/1">One &amp; Co</a><td><a href="/r">Rank 1</a><td><a href="/c/2">Equity</a><td>10.5<td>--<td>5
<tr><td><a href="/s/2">Two</a></td><td><a href="/r">Not Ranked</a></td><td>-</td><td>7</td><td>3.2</td></tr>
<tr><td colspan=6>Total</td></tr></table></div></div>
<div class="FL MT10"><table><tr><td>no</td></tr><tr><td>no</td></tr><tr><td>no</td></tr></table></div>"""
DETAIL = """<div class="header"><div class="MT10"><div class="toplft_cl3"><p class="avgbgtit"> High </p></div></div></div>
<div id="planname_frm"><div class="FL"><span> Regular </span><span>Growth</span></div></div>
<div class="mainCont"><div class="tog_cont"><table>
<tr><td>only one</td></tr>
<tr><td>Period</td><td>1m</td></tr>
<tr><td> FUND Returns </td><td>1.5</td><td>--</td><td>N.A.</td><td>4</td><td>5</td><td>6</td><td>7</td></tr>
<tr><td>rank</td><td>9</td></tr>
<tr><td>Best of category</td><td>8</td></tr>
<tr><td>fund returns</td><td>2.5</td><td>3</td></tr>
</table><div class="MT20"><div class="FL"><table><tr><td> Open </td><td>a</td><td>b</td><td><i>Index</i></td><td>c</td><td>Rs. 5,000</td><td>N.A.</td><td> </td></tr></table></div></div></div></div>"""


def page(spark, *bodies):
    rows = [(i, f"u{i}", b) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_family_table(spark):
    rows = extract.family_rows(page(spark, FAMILIES, "<p>tblfund1</p>", None), ROOT).orderBy("row_no").collect()
    assert len(rows) == 10
    assert tuple(rows[0])[2:] == ("Fam 0", "http://h/amc/F0", "0,000.5", "F0")
    assert rows[-1].family_name == "Fam 9"
    assert extract.family_rows(page(spark, FAMILIES), ROOT, keep=3).count() == 3


def test_scheme_table(spark):
    rows = extract.scheme_rows(page(spark, SCHEMES), ROOT).orderBy("row_no").collect()
    assert [tuple(r)[2:] for r in rows] == [
        ("One & Co", "http://h/s/1", "Rank 1", "Equity", "http://h/c/2", "10.5", None, "5\n"),
        ("Two", "http://h/s/2", "Not Ranked", None, None, "7", "3.2", None),
    ]


def test_details(spark):
    parsed = extract.parse_details(page(spark, DETAIL, "<html></html>"))
    first, second = extract.detail_fields(parsed).orderBy("page_id").collect()
    assert tuple(first)[1:] == (" High ", "Regular", "Growth", "Open", "Index", "Rs. 5,000", None, None)
    assert tuple(second)[1:] == (None,) * 8


def test_performance(spark):
    parsed = extract.parse_details(page(spark, DETAIL))
    rows = extract.performance_rows(parsed).filter("value IS NOT NULL").orderBy("row_no", "horizon").collect()
    found = [(r.row_no, r.measure, r.horizon, r.value) for r in rows]
    assert (1, "fund_ret", "1m", "1.5") in found and (1, "fund_ret", "5y", "7") in found
    assert (3, "cat_best", "1m", "8") in found
    assert {m for _, m, _, _ in found} == {"fund_ret", "cat_best"}
    wide = extract.performance_columns(parsed).first()
    # The later of two rows with one label stands for the scheme, short as it is.
    assert (wide.fund_ret_1m, wide.fund_ret_3m, wide.fund_ret_1y, wide.cat_best_1m) == ("2.5", "3", None, "8")
    assert wide.cat_worst_5y is None


def test_options(spark):
    body = """<select id="Other"><option value="z">A</option></select>
    <select name="m" id="MFName"><option value="">Select</option><option value=" ">Blank</option>
    <option value="1">A &amp; B</option><option selected value="2">C</option><option value="3">A &amp; B</option></select>"""
    found = {tuple(r) for r in extract.option_dimension(page(spark, body), "MFName").collect()}
    assert found == {("A & B", "3"), ("C", "2")}


def test_flat_patterns(spark):
    pages = page(spark, '<title> T </title><a href="/x">X</a><a href="/y">', "<title></title>")
    assert [tuple(r) for r in extract.page_title(pages).orderBy("page_id").collect()] == [(0, " T "), (1, None)]
    found = [tuple(r) for r in extract.anchors(pages, ROOT).orderBy("pos").collect()]
    assert found == [(0, 0, "/x", "http://h/x"), (0, 1, "/y", "http://h/y")]


def test_anchors_and_titles_of_any_spelling(spark):
    html = "<TITLE lang=en>T\nx</TITLE><a class=\"k\" href=\"/x\">1</a><A href='/y' id=q>2</A><a data-href=\"/no\">3</a><a\nhref = \"/z\">4</a>"
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    assert [r.href for r in extract.anchors(pages, "").orderBy("pos").collect()] == ["/x", "/y", "/z"]
    assert extract.page_title(pages).first().title == "T\nx"
