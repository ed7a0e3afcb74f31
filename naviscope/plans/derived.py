"""Feed files and saved pages written by Spark from the scheme tables.

The star-schema tables hold no sectioned feed and no scheme pages. These
builders render the same facts as the text a provider would publish, so that
the whole way back - scan, sections, parse - runs on data that grows with the
tables and can be compared with the facts it came from.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from naviscope.plans import binding
from naviscope.schemas import HORIZONS, MEASURES
from naviscope.session import new_folder

FEED_HEADINGS = ("Code", "K1", "K2", "Scheme Name", "Value", "Day")
ROWS_PER_FILE = 1000
ROWS_PER_PAGE = 50
DIMENSION_PAGE = 1


def feed_lines(part):
    """(feed, ord, n, line) of one feed file per 1,000 schemes.

    Within a file schemes are grouped by type and family. A new type is
    announced by two marker lines, a new family of the same type by one.
    """
    rows = part.selectExpr(
        "p_partkey",
        f"p_partkey div {ROWS_PER_FILE} AS feed",
        "concat(p_type, ' Ended (Plan (', p_type, '))') AS type_line",
        "p_brand",
        "p_type",
        "concat_ws(';', p_partkey, concat('K', p_size), ' B ', "
        "concat(replace(p_name, ' ', '   '), '  - Growth - ', p_size), "
        "string(cast(p_retailprice AS decimal(18,2))), concat('d', p_size % 28)) AS data",
    )
    order = [F.col("p_type"), F.col("p_brand"), F.col("p_partkey")]
    w = Window.partitionBy("feed").orderBy(*order)
    rows = rows.select(
        "*",
        F.row_number().over(w).alias("ord"),
        F.lag("p_type").over(w).alias("last_type"),
        F.lag("p_brand").over(w).alias("last_brand"),
    )
    lines = """
        filter(array(
            if(ord = 1, 'Code;K1 ; K2;Scheme Name;Value;Day', NULL),
            if(NOT p_type <=> last_type, '', NULL),
            if(NOT p_type <=> last_type, concat(type_line, ' '), NULL),
            if(NOT p_type <=> last_type, '   ', NULL),
            if(NOT (p_type <=> last_type AND p_brand <=> last_brand), p_brand, NULL),
            concat(data, '\\r')
        ), x -> x IS NOT NULL)
    """
    return rows.select("feed", "ord", F.posexplode(F.expr(lines)).alias("n", "line"))


def write_feed(spark, sf_dir, part=None, path=None):
    """Folder of feed files, each written by one task in line order; files are added to a `path` that is there."""
    path = path or new_folder(spark, "feed")
    lines = feed_lines(binding.table(spark, sf_dir, "part") if part is None else part)
    (
        lines.repartition("feed")
        .sortWithinPartitions("feed", "ord", "n")
        .select("feed", "line")
        .write.mode("append")
        .partitionBy("feed")
        .option("lineSep", "\n")
        .text(path)
    )
    return path


def family_dimension_page(part):
    """One drop-down page listing every family; blank and repeated entries included."""
    options = part.select("p_brand").distinct().selectExpr(
        "p_brand",
        """concat('<option value="old">', p_brand, '</option>') AS old""",
        """concat('<option value="', substring_index(p_brand, '#', -1), '">', p_brand, '</option>') AS new""",
    )
    # One entry per family: the list is as long as the drop-down it stands for.
    listed = options.agg(F.array_sort(F.collect_list("old")).alias("old"), F.collect_list("new").alias("new"))
    return listed.selectExpr(
        f"bigint({DIMENSION_PAGE}) AS page_id",
        "'http://funds.example/families' AS url",
        """concat('<html><select id="MFName"><option value="">Select</option><option value=" ">-</option>',
        concat_ws('', old), concat_ws('', new), '</select></html>') AS html""",
    )


def family_pages(families):
    """One page listing all families in name order, under a header row."""
    rows = families.selectExpr(
        "family_name",
        f"""concat('<tr><td><a href="', substring(family_url, {len(binding.ROOT) + 1}), '">', family_name,
        '</a></td><td>x</td><td>', family_aum, '</td></tr>') AS row""",
    )
    listed = rows.agg(F.array_sort(F.collect_list(F.struct("family_name", "row"))).alias("rows"))
    return listed.selectExpr(
        "bigint(0) AS page_id",
        "'http://funds.example/assets' AS url",
        """concat('<html><body><table class="menu"><tr><td>m</td></tr></table><table class="tblfund1">',
        '<tr><th>Family</th><th>x</th><th>Assets</th></tr>',
        concat_ws('\n', transform(rows, r -> r.row)), '</table></body></html>') AS html""",
    )


def scheme_pages(schemes):
    """Family pages of 50 schemes each: page_id = scheme_idx div 50 per family.

    The page number is part of the key, so no family makes a page longer.
    """
    root = len(binding.ROOT) + 1
    row = f"""concat('<tr><td><a href="', substring(scheme_url, {root}), '">', scheme_name, '</a></td>',
        '<td><a href="/r">', crisil_rating, '</a></td>',
        if(scheme_idx % 7 = 0, '<td>-</td>', concat('<td><a href="', substring(category_url, {root}), '">', category, '</a></td>')),
        '<td>', latest_nav, '</td><td>', `1yr_return`, '</td>',
        if(scheme_idx % 11 = 0, '', concat('<td>', scheme_aum, '</td>')), '</tr>')"""
    rows = schemes.selectExpr(
        "family_url", f"scheme_idx div {ROWS_PER_PAGE} AS page", f"struct(scheme_idx, {row} AS row) AS r"
    )
    pages = rows.groupBy("family_url", "page").agg(F.array_sort(F.collect_list("r")).alias("rows"))
    return pages.selectExpr(
        "page * 1000 + int(substring_index(family_url, '-', -1)) AS page_id",
        "family_url AS url",
        """concat('<html><div class="FL MT10 boxBg"><table><tr><th>Scheme</th></tr>',
        concat_ws('', transform(rows, r -> r.row)), '<tr><td>Total</td></tr></table></div></html>') AS html""",
    )


def _cell(measure, horizon):
    text = f"string(cast({measure}_{horizon} AS decimal(28,9)))"
    return f"coalesce({text}, '--')"


def detail_pages(wide):
    """One page per scheme with its details and performance table."""
    labels = {v: k for k, v in MEASURES.items()}
    rows = []
    for i, (measure, label) in enumerate(labels.items()):
        shown = label.title() if i % 2 else f" {label} "
        cells = ", ".join(f"'<td>', {_cell(measure, h)}, '</td>'" for h in HORIZONS)
        rows.append(f"'<tr><td>{shown}</td>', {cells}, '</tr>'")
    return wide.selectExpr(
        "scheme_idx AS page_id",
        "scheme_url AS url",
        f"""concat(
        '<html><div class="header"><div class="MT10"><div class="toplft_cl3"><p class="avgbgtit big">', scheme_risk_text,
        '</p></div></div></div><form id="planname_frm"><div class="FL">',
        if(scheme_idx % 5 = 0, '', concat('<span> ', scheme_plan, ' </span><span>', scheme_option, '</span>')),
        '</div></form><div class="mainCont"><div class="tog_cont"><table><tr><td>Period</td><td>1</td></tr>',
        {', '.join(rows)}, '<tr><td>Other</td><td>1</td></tr></table><div class="MT20"><div class="FL"><table><tr><td>',
        scheme_fund_type, '</td><td>a</td><td>b</td><td>', scheme_benchmark, '</td><td>c</td><td>',
        scheme_min_investment, '</td><td> ', scheme_last_dividend, ' </td><td>', scheme_bonus,
        '</td></tr></table></div></div></div></div></html>') AS html""",
    )
