import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from naviscope.functions import scores, text

NUMBERS = [
    ("Rs. 5,000", 5000.0), ("Rs 5000", 5000.0), ("Rank 3", 3.0), ("5.2%", 5.2), ("--", None),
    ("-", None), ("None", None), ("1e5", 15.0), ("(5.2)", 5.2), ("Hours. 5", 5.0),
    ("INR. 500", 0.5), ("5.", 5.0), (".5", 0.5), ("-.5", -0.5), (".", None), ("1.2.3", None),
    ("5-LOW", None), ("5|6", None), ("", None), ("Brand#17", 17.0), ('{"k": 69}', 69.0),
    ("Rs . 12", 12.0), ("rs..5", 0.5), ("-0", -0.0), ("٣", None), ("0005", 5.0), ("+5", 5.0),
    (None, None),
]
RISKS = [
    ("HIGH", 1), ("Moderately High", 2), ("moderate", 3), ("MODERATELY LOW", 4), ("low", 5),
    (" HIGH ", 0), ("None", 0), (None, 0),
]


def apply(spark, values, *columns):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    rows = df.select("i", *columns).orderBy("i").collect()
    return [tuple(r)[1:] if len(columns) > 1 else r[1] for r in rows]


def test_numbers(spark):
    assert apply(spark, [x for x, _ in NUMBERS], text.to_numeric("x")) == [y for _, y in NUMBERS]


def test_risks(spark):
    assert apply(spark, [x for x, _ in RISKS], text.encode_risk("x")) == [y for _, y in RISKS]


def test_sql_functions_agree(spark):
    text.register_sql(spark)
    values = [x for x, _ in NUMBERS + RISKS]
    native = apply(spark, values, text.to_numeric("x"), text.encode_risk("x"))
    assert apply(spark, values, F.expr("to_numeric(x)"), F.expr("encode_risk(x)")) == native


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text("0123456789.-|,RsankAn% ", max_size=12), min_size=20, max_size=60))
def test_numbers_match_a_direct_reading(spark, values):
    def direct(x):
        kept = re.sub(r"(?i)Rs *\.|[^0-9|.-]", "", x)
        try:
            return float(kept)
        except ValueError:
            return None

    assert apply(spark, values, text.to_numeric("x")) == [direct(v) for v in values]


def test_missing_tokens(spark):
    values = ["NA", " N.A. ", "--", "-", "None", "", "  ", "x", " y ", None]
    assert apply(spark, values, text.null_missing("x")) == [None] * 7 + ["x", " y ", None]
    assert apply(spark, ["--", "NA"], text.null_missing("x", ("--",))) == [None, "NA"]


def test_zeroes(spark):
    assert apply(spark, ["Rs. 2", "None", None, "a"], text.missing_to_zero("x")) == [2.0, 0.0, 0.0, 0.0]
    assert apply(spark, ["2", None], text.zero_fill("x")) == [2.0, 0.0]


@pytest.mark.parametrize(
    ("value", "collapsed", "short"),
    [
        ("  Alpha \t Bond  Fund - Growth ", "Alpha Bond Fund - Growth", "Alpha Bond Fund"),
        ("Beta Bond-Plan A-Growth", "Beta Bond-Plan A-Growth", "Beta Bond"),
        ("\r\n", "", ""),
        ("Cash", "Cash", "Cash"),
    ],
)
def test_names(spark, value, collapsed, short):
    assert apply(spark, [value], text.collapse_spaces("x"), text.short_name("x")) == [(collapsed, short)]


def test_composite(spark):
    values = ["A(B(C))x", "none", "Open Ended (Income)", ")(", None]
    found = apply(spark, values, text.before_last_paren("x"), text.between_parens("x"))
    assert found == [("A(B", "B(C)"), (None, None), ("Open Ended ", "Income"), (")", None), (None, None)]


def test_fields_and_codes(spark):
    assert apply(spark, [" a ;\tb;;c \r"], text.split_fields("x")) == [["a", "b", "", "c"]]
    assert apply(spark, ["http://h/a/b"], text.url_shortcode("x")) == ["b"]
    assert apply(spark, ["/a"], text.absolute_url("http://h", "x")) == ["http://h/a"]
    assert apply(spark, ["a;b", "a"], text.is_marker("x")) == [False, True]
    assert apply(spark, ["  \r", "a"], text.is_blank("x")) == [True, False]
    assert apply(spark, ["a &amp;amp; b &lt;"], text.unescape("x")) == ["a &amp; b <"]


def test_rounding_is_away_from_zero(spark):
    df = spark.createDataFrame([(v,) for v in (0.5, 1.5, 2.5, -0.5)], "x double")
    assert [r[0] for r in df.select(scores.half_up(F.col("x"))).collect()] == [1.0, 2.0, 3.0, -1.0]


def test_every_unicode_blank_counts(spark):
    assert apply(spark, ["a\x1c\x1db", "\x1fx\x1e"], text.collapse_spaces("x")) == ["a b", "x"]
    assert apply(spark, ["\x1c a\x1f"], text.strip("x")) == ["a"]
    assert apply(spark, ["\x1f", " ", "a"], text.is_blank("x")) == [True, True, False]
