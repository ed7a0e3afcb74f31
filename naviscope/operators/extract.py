"""Rows and fields out of saved web pages.

Flat patterns are native regular expressions. Nested tables need a real HTML
parse, done by `functions.html` inside `mapInArrow`, one page at a time;
what it returns are plain cells, and every rule about them is a column
expression again.
"""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from naviscope.functions import html, text
from naviscope.schemas import CELL, HORIZONS, MEASURES


def parse_pages(pages, wanted, must_contain=None):
    """One parse per page: (page_id, one `array<array<cell>>` per wanted table).

    `wanted` maps a column name to (selector, mode). mode `rows`: every node the
    selector matches is a table row; `first_table`: the rows of the first match;
    `children`: the same, rows that hold one single string left out; `nodes`:
    one row whose cells are all matches. `must_contain` skips pages without that
    text before any parsing.
    """
    plan = {name: (html.parse_selector(selector), mode) for name, (selector, mode) in wanted.items()}
    schema = T.StructType(
        [T.StructField("page_id", T.LongType())]
        + [T.StructField(name, T.ArrayType(T.ArrayType(CELL))) for name in plan]
    )
    kept = pages.filter(F.col("html").isNotNull())
    if must_contain:
        kept = kept.filter(F.contains(F.col("html"), F.lit(must_contain)))
    kept = kept.select(F.col("page_id").cast("long").alias("page_id"), "html")
    return kept.mapInArrow(html.page_parser(plan), schema)


def table_rows(parsed, name):
    """One row per table row: (page_id, row_no, n_rows, cells)."""
    return parsed.select(
        "page_id", F.size(name).alias("n_rows"), F.posexplode(name).alias("row_no", "cells")
    ).select("page_id", "row_no", "n_rows", "cells")


def first_rows(rows, keep=10):
    """Rows 1..keep: the header row skipped."""
    return rows.filter(F.col("row_no").between(1, keep))


def inner_rows(rows):
    """All but the first and the last row of each page."""
    return rows.filter((F.col("row_no") > 0) & (F.col("row_no") < F.col("n_rows") - 1))


def cell(i, field="text"):
    return F.get(F.col("cells"), F.lit(i)).getField(field)


def anchors(pages, root):
    """(page_id, pos, href, url): every anchor with its absolute address."""
    hrefs = F.regexp_extract_all("html", F.lit(r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*(["'])(.*?)\1"""), F.lit(2))
    return pages.select("page_id", F.posexplode(hrefs).alias("pos", "href")).withColumn(
        "url", text.absolute_url(root, "href")
    )


def page_title(pages):
    """(page_id, title): the first title, empty as missing, blanks kept."""
    title = F.regexp_extract("html", r"(?is)<title(?:\s[^>]*)?>(.*?)</title>", 1)
    return pages.select("page_id", F.nullif(title, F.lit("")).alias("title"))


# Where a family list and a family page keep their rows.
FAMILY_TABLE = "table.tblfund1"
SCHEME_ROWS = ".FL.MT10.boxBg table tr"


def family_rows(pages, root, table=FAMILY_TABLE, keep=10):
    """Families of the first matching table: name and link, assets, short code."""
    parsed = parse_pages(pages, {"families": (table, "first_table")}, "tblfund1")
    rows = first_rows(table_rows(parsed, "families"), keep)
    url = text.absolute_url(root, cell(0, "href"))
    return rows.select(
        "page_id",
        "row_no",
        cell(0, "link_text").alias("family_name"),
        url.alias("family_url"),
        cell(2).alias("family_aum"),
        text.url_shortcode(url).alias("family_shortcode"),
    )


def scheme_rows(pages, root, rows_selector=SCHEME_ROWS):
    """Schemes of a family page; absent category, return or assets are null."""
    parsed = parse_pages(pages, {"schemes": (rows_selector, "rows")}, "boxBg")
    rows = inner_rows(table_rows(parsed, "schemes"))
    return rows.select(
        "page_id",
        "row_no",
        cell(0, "link_text").alias("scheme_name"),
        text.absolute_url(root, cell(0, "href")).alias("scheme_url"),
        cell(1, "link_text").alias("crisil_rating"),
        cell(2, "link_text").alias("category"),
        text.absolute_url(root, cell(2, "href")).alias("category_url"),
        cell(3).alias("latest_nav"),
        text.null_missing(cell(4)).alias("1yr_return"),
        cell(5).alias("scheme_aum"),
    )


def option_dimension(pages, select_id, label="family", value="family_id"):
    """(label, value) of a drop-down list; blank values dropped, the last label wins."""
    inside = F.regexp_extract("html", rf'(?s)<select[^>]*id="{select_id}"[^>]*>(.*?)</select>', 1)
    pattern = F.lit(r'(?s)<option[^>]*value="([^"]*)"[^>]*>([^<]*)')
    pairs = F.arrays_zip(
        F.regexp_extract_all(inside, pattern, F.lit(1)).alias("value"),
        F.regexp_extract_all(inside, pattern, F.lit(2)).alias("label"),
    )
    options = pages.select("page_id", F.posexplode(pairs).alias("pos", "option")).select(
        "page_id",
        "pos",
        text.unescape("option.label").alias("label"),
        text.unescape("option.value").alias("value"),
    )
    options = options.filter(~text.is_blank("value"))
    return last_wins(options, ["label"], F.struct("page_id", "pos"), ["value"]).select(
        F.col("label").alias(label), F.col("value").alias(value)
    )


def last_wins(df, keys, order, values):
    """One row per key with the values of the row that comes last in `order`."""
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*values), order).alias("__last"))
    return last.select(*keys, "__last.*")


def _available(x):
    stripped = text.strip(x)
    return F.when(~stripped.isin("N.A.", ""), stripped)


# Where a scheme page keeps its details.
DETAIL_TABLES = {
    "risk": (".header .MT10 .toplft_cl3 p.avgbgtit", "nodes"),
    "plan": ("#planname_frm .FL span", "nodes"),
    "facts": (".mainCont .tog_cont .MT20 .FL td", "nodes"),
    "performance": (".mainCont .tog_cont table", "children"),
}


def parse_details(pages):
    """Scheme pages parsed once, for `detail_fields` and `performance_rows`."""
    return parse_pages(pages, DETAIL_TABLES)


def detail_fields(parsed):
    """Risk text, plan and option, and five investment facts per scheme page."""
    def node(name, i):
        return F.get(F.get(F.col(name), F.lit(0)), F.lit(i)).getField("text")

    return parsed.select(
        "page_id",
        node("risk", 0).alias("scheme_risk_text"),
        text.strip(node("plan", 0)).alias("scheme_plan"),
        text.strip(node("plan", 1)).alias("scheme_option"),
        _available(node("facts", 0)).alias("scheme_fund_type"),
        _available(node("facts", 3)).alias("scheme_benchmark"),
        _available(node("facts", 5)).alias("scheme_min_investment"),
        _available(node("facts", 6)).alias("scheme_last_dividend"),
        _available(node("facts", 7)).alias("scheme_bonus"),
    )


def performance_rows(parsed, horizons=HORIZONS):
    """(page_id, row_no, measure, horizon, value) of the labelled performance rows."""
    rows = table_rows(parsed, "performance").filter(F.col("row_no") > 0)
    label = F.lower(text.strip(cell(0)))
    names = F.create_map(*[F.lit(v) for pair in MEASURES.items() for v in pair])
    values = F.array(
        *[
            F.struct(F.lit(h).alias("horizon"), text.null_missing(cell(i)).alias("value"))
            for i, h in enumerate(horizons, start=1)
        ]
    )
    known = rows.filter(label.isin(*MEASURES))
    return known.select("page_id", "row_no", names[label].alias("measure"), F.inline(values))


def performance_columns(parsed, horizons=HORIZONS):
    """The 35 wide columns straight from each page's own rows, without a shuffle.

    Of several rows with the same label the last wins.
    """
    rows = F.slice("performance", F.lit(2), F.size("performance"))
    out = []
    for label, measure in MEASURES.items():
        hits = F.filter(rows, lambda r: F.lower(text.strip(F.get(r, F.lit(0))["text"])) == label)
        row = F.try_element_at(hits, F.lit(-1))
        for i, h in enumerate(horizons, start=1):
            value = text.null_missing(F.get(row, F.lit(i))["text"])
            out.append(value.alias(f"{measure}_{h}"))
    return parsed.select("page_id", *out)
