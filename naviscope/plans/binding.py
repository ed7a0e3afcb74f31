"""The scheme model bound to the star-schema tables part and lineitem.

A part is a scheme, its brand the family, type and size the category. Assets
and returns come from the line items: money is summed as whole cents, so the
sums are exact whatever the order of the rows, and one pass over lineitem
yields every fact of a scheme.
"""

from pyspark.sql import functions as F

from naviscope.operators import ranking, reshape, schemes
from naviscope.schemas import FAMILY_COLUMNS, HORIZONS, TABLES
from naviscope.session import materialise

ROOT = "http://funds.example"

# Part type -> risk text; LARGE has none on purpose.
RISK_TEXTS = {
    "SMALL": "HIGH",
    "PROMO": "Moderately High",
    "MEDIUM": "MODERATE",
    "ECONOMY": "moderately low",
    "STANDARD": "LOW",
    "LARGE": "unknown",
}

# A part's name on the site, and in a feed: as it is, one letter less, words swapped, a word more, a letter twice.
SITE_NAME = "concat_ws(' ', p_name, lower(p_type), 'fund', translate(p_brand, '#', ' '), 'series', p_partkey)"
FEED_NAME = """CASE p_partkey % 5
    WHEN 0 THEN concat_ws('  ', upper(p_name), lower(p_type), 'Fund', translate(p_brand, '#', '-'), 'Series', p_partkey)
    WHEN 1 THEN concat_ws(' ', concat(substr(p_name, 1, 2), substr(p_name, 4)), lower(p_type), 'fund', translate(p_brand, '#', ' '), 'series', p_partkey)
    WHEN 2 THEN concat_ws(' ', lower(p_type), p_name, 'fund', 'series', p_partkey, translate(p_brand, '#', ' '))
    WHEN 3 THEN concat_ws(' ', p_name, lower(p_type), 'fund', translate(p_brand, '#', ' '), 'series', p_partkey, 'growth')
    ELSE concat_ws(' ', p_name, lower(p_type), 'fundd', translate(p_brand, '#', ' '), 'series', p_partkey) END"""

# Month marks that bound the current and the previous window of each horizon.
MARKS = sorted({0, *HORIZONS.values(), *(2 * n for n in HORIZONS.values())})


def table(spark, sf_dir, name):
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def last_ship_date(lineitem):
    """The date all horizons look back from; one value, from a one-column scan."""
    return lineitem.agg(F.max("l_shipdate")).first()[0]


def _segment(as_of):
    """Which of the month segments before `as_of` a row falls in, 0 the newest, -1 none."""
    segment = F.lit(-1)
    for i in range(len(MARKS) - 1, 0, -1):
        start = F.lit(as_of) - F.make_ym_interval(F.lit(0), F.lit(MARKS[i]))
        segment = F.when(F.col("l_shipdate") > start, i - 1).otherwise(segment)
    return segment


def cents(price):
    return F.rint(F.col(price) * 100).cast("long")


def scheme_totals(lineitem):
    """(scheme_idx, cents): assets alone, for the family ranking."""
    return lineitem.groupBy(F.col("l_partkey").alias("scheme_idx")).agg(
        F.sum(cents("l_extendedprice")).alias("aum_cents")
    )


def scheme_facts(lineitem, as_of=None):
    """Assets, smallest order, last dividend and the seven returns per scheme.

    One sum per month segment: a scheme leaves each task as one row, however
    many rows it has, and is shuffled once.
    """
    as_of = as_of or last_ship_date(lineitem)
    rows = lineitem.select(
        F.col("l_partkey").alias("scheme_idx"),
        _segment(as_of).alias("seg"),
        cents("l_extendedprice").alias("cents"),
        F.col("l_quantity").cast("long").alias("qty"),
        # Latest date first, then the highest rate, packed so that a plain max finds it.
        F.expr("unix_date(date(l_shipdate)) * 1000L + bigint(rint(l_tax * 100))").alias("dated_tax"),
    )
    sums = rows.groupBy("scheme_idx").agg(
        F.sum("cents").alias("aum_cents"),
        F.min("qty").alias("min_qty"),
        (F.max("dated_tax") % 1000).alias("tax_cents"),
        *[F.sum(F.when(F.col("seg") == i, F.col(x))).alias(f"{x}_{i}") for i in range(len(MARKS) - 1) for x in ("cents", "qty")],
    )

    def vwap(low, high):
        """Price per unit over (as_of - high months, as_of - low months]."""
        inside = [i for i, m in enumerate(MARKS[1:]) if MARKS[i] >= low and m <= high]
        c, q = (" + ".join(f"coalesce({x}_{i}, 0)" for i in inside) for x in ("cents", "qty"))
        return f"try_divide(({c}) / 100.0D, {q})"

    def fund_return(months):
        growth = f"try_divide({vwap(0, months)}, {vwap(months, 2 * months)})"
        return f"round(({growth} - 1) * 100, 4)"

    return sums.select(
        "scheme_idx",
        "aum_cents",
        "min_qty",
        "tax_cents",
        *[F.expr(fund_return(m)).alias(f"fund_ret_{h}") for h, m in HORIZONS.items()],
    )


def _money(c):
    """Cents as text with two decimals."""
    return f"concat(string({c} div 100), '.', lpad(string({c} % 100), 2, '0'))"


def _decimal(c, places):
    return f"string(cast({c} AS decimal(18,{places})))"


def _family_url(brand):
    return f"concat('{ROOT}/families/', replace({brand}, '#', '-'))"


def stored_facts(spark, sf_dir):
    """`scheme_facts`, written once: the one pass over the line items.

    Families, categories and returns all start from this table, which has one
    row per scheme, instead of each scanning the line items again.
    """
    return materialise(scheme_facts(table(spark, sf_dir, "lineitem")), "scheme-facts")


def family_totals(part, totals):
    """(family, cents) over all schemes; the sums are exact at any size."""
    families = part.selectExpr("p_partkey AS scheme_idx", "p_brand AS family_name")
    joined = totals.select("scheme_idx", "aum_cents").join(families, "scheme_idx")
    return joined.groupBy("family_name").agg(F.sum("aum_cents").alias("family_cents"))


def families(part, totals):
    """Raw family rows: everything text but the number used for ranking."""
    return family_totals(part, totals).selectExpr(
        "family_name",
        f"{_family_url('family_name')} AS family_url",
        f"concat('Rs. ', {_money('family_cents')}) AS family_aum",
        "replace(family_name, '#', '-') AS family_shortcode",
        "family_cents / 100D AS num_family_aum",
    )


def all_families(spark, sf_dir):
    """`families` straight from the tables, for queries that need nothing else."""
    totals = scheme_totals(table(spark, sf_dir, "lineitem"))
    return families(table(spark, sf_dir, "part"), totals)


def schemes_text(part, facts, also=()):
    """Raw scheme rows, every attribute as text; `also` names more columns of `part`."""
    risks = ", ".join(f"'{k}', '{v}'" for k, v in RISK_TEXTS.items())
    base = part.withColumnRenamed("p_partkey", "scheme_idx").join(facts, "scheme_idx")
    return base.selectExpr(
        *also,
        "scheme_idx",
        "concat_ws(' ', p_name, scheme_idx) AS scheme_name",
        f"concat('{ROOT}/schemes/', scheme_idx) AS scheme_url",
        *([] if "family_url" in also else [f"{_family_url('p_brand')} AS family_url"]),
        "concat('Rank ', 1 + p_size % 5) AS crisil_rating",
        "concat_ws('-', p_type, p_size) AS category",
        f"concat('{ROOT}/categories/', p_type, '-', p_size) AS category_url",
        f"{_decimal('p_retailprice', 2)} AS latest_nav",
        f"coalesce({_decimal('fund_ret_1y', 4)}, '--') AS `1yr_return`",
        f"concat('Rs. ', {_money('aum_cents')}) AS scheme_aum",
        f"try_element_at(map({risks}), p_type) AS scheme_risk_text",
        "'Regular' AS scheme_plan",
        "if(p_size % 2 = 0, 'Growth', 'Dividend') AS scheme_option",
        "concat(p_type, ' ended') AS scheme_fund_type",
        "concat('Index ', p_type) AS scheme_benchmark",
        "concat('Rs. ', min_qty) AS scheme_min_investment",
        f"{_money('tax_cents')} AS scheme_last_dividend",
        "'N.A.' AS scheme_bonus",
        *[f"coalesce({_decimal(f'fund_ret_{h}', 4)}, '--') AS fund_ret_{h}" for h in HORIZONS],
    )


def selected_schemes(spark, sf_dir, n_families=10):
    """Text rows of the schemes in the largest families, family columns added.

    The families are stored once they are known; the join with them comes first,
    so that only their schemes go on.
    """
    part, facts = table(spark, sf_dir, "part"), stored_facts(spark, sf_dir)
    top = schemes.top_families(families(part, facts), n_families).drop("num_family_aum")
    part = part.withColumn("family_name", F.col("p_brand"))
    mine = schemes.expand_families(materialise(top, "families"), part, "family_name")
    return schemes_text(mine, facts, also=FAMILY_COLUMNS)


def scheme_wide(spark, sf_dir, n_families=10):
    """One row per selected scheme with its numbers and 35 performance columns."""
    numbers = schemes.add_numbers(selected_schemes(spark, sf_dir, n_families))
    stats = materialise(schemes.category_benchmarks(numbers), "categories")
    return schemes.add_category_benchmarks(numbers, stats)


def scheme_long(spark, sf_dir, n_families=10):
    return reshape.by_horizon(scheme_wide(spark, sf_dir, n_families))


def label_rows(spark, sf_dir, wide):
    """One row per scheme and horizon of `wide` with scores, label and train flag."""
    rows = schemes.add_label(schemes.add_scores(reshape.by_horizon(wide)))
    positions = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("scheme_idx"))
    return ranking.add_train_flag(rows, positions)


def labelled(spark, sf_dir, n_families=10):
    return label_rows(spark, sf_dir, scheme_wide(spark, sf_dir, n_families))
