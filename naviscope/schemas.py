"""Declared schemas and the fixed values every other module refers to."""

from pyspark.sql import types as T

# Horizon suffix -> months.
HORIZONS = {"1m": 1, "3m": 3, "6m": 6, "1y": 12, "2y": 24, "3y": 36, "5y": 60}

# Texts that stand for a missing cell.
MISSING_TOKENS = ("NA", "N.A.", "--", "-", "None", "")

# Risk text -> code, the riskier the lower; unknown text is 0.
RISK_CODES = {
    "HIGH": 1,
    "MODERATELY HIGH": 2,
    "MODERATE": 3,
    "MODERATELY LOW": 4,
    "LOW": 5,
}

# Row label of the performance table -> measure column.
MEASURES = {
    "fund returns": "fund_ret",
    "category avg": "cat_avg",
    "difference of fund returns and category returns": "diff",
    "best of category": "cat_best",
    "worst of category": "cat_worst",
}

# Model features f0..f9, in order.
FEATURE_NAMES = (
    "Scheme Risk",
    "CRISIL Rating",
    "Fund Family AUM",
    "Scheme AUM",
    "Latest NAV",
    "Minimum Investment",
    "Last Dividend",
    "Bonus",
    "Fund Return",
    "Category Return",
)

# Features left out of the importance report as too sparse.
SPARSE_FEATURES = ("Last Dividend", "Bonus")

# Trees per horizon of the final forests.
CHOSEN_TREES = {"1m": 27, "3m": 3, "6m": 2, "1y": 20, "2y": 8, "3y": 3, "5y": 20}

# Headings appended to the feed's own.
DERIVED_HEADINGS = (
    "Scheme Classification",
    "Scheme Type",
    "Scheme Category",
    "Fund Family",
    "Fund ID",
    "Scheme Short Name",
)

# 1,000 training rows of 1,296.
TRAIN_RATIO = 1000 / 1296


def _strings(*names):
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


FAMILY_COLUMNS = ("family_name", "family_url", "family_aum", "family_shortcode")
FAMILY_SCHEMA = _strings(*FAMILY_COLUMNS)

SCHEME_COLUMNS = (
    "scheme_name",
    "scheme_url",
    "crisil_rating",
    "category",
    "category_url",
    "latest_nav",
    "1yr_return",
    "scheme_aum",
)
SCHEME_SCHEMA = _strings(*FAMILY_COLUMNS, *SCHEME_COLUMNS)

DETAIL_COLUMNS = (
    "scheme_risk_text",
    "scheme_plan",
    "scheme_option",
    "scheme_fund_type",
    "scheme_benchmark",
    "scheme_min_investment",
    "scheme_last_dividend",
    "scheme_bonus",
)
DETAIL_SCHEMA = _strings("scheme_url", *DETAIL_COLUMNS)

PERFORMANCE_SCHEMA = _strings("scheme_url", "measure", "horizon", "value")

CELL = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("link_text", T.StringType()),
        T.StructField("href", T.StringType()),
    ]
)


# Numeric columns of a scheme that do not depend on the horizon.
NUMERIC_COLUMN_ORDER = (
    "num_scheme_risk",
    "num_scheme_aum",
    "num_family_aum",
    "num_crisil_rating",
    "num_latest_nav",
    "num_1yr_return",
    "num_min_investment",
    "num_last_dividend",
    "num_bonus",
)


# Declared, so that reading a table of many files starts without opening any.
TABLES = {
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "pages": "page_id bigint, url string, html string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def measure_columns(horizons=HORIZONS):
    """The 35 wide performance columns, measure by measure."""
    return [f"{m}_{h}" for m in MEASURES.values() for h in horizons]
