import pytest
from pyspark.sql import functions as F

from naviscope.operators import ranking, reshape, schemes
from naviscope.plans import binding
from naviscope.schemas import HORIZONS, measure_columns

LONG = (
    "scheme_idx long, horizon string, num_scheme_risk int, num_crisil_rating double, num_scheme_aum double, "
    "num_family_aum double, diff double, cat_worst double, cat_best double"
)


def scored(spark, rating=None, aum=20.0, family=100.0, diff=None, worst=None, best=None, risk=0):
    row = (1, "1m", risk, rating, aum, family, diff, worst, best)
    return schemes.add_label(schemes.add_scores(spark.createDataFrame([row], LONG))).first()


def test_rating_and_risk(spark):
    assert scored(spark).m_rating == 0
    assert scored(spark, rating=4.0, risk=5).m_rating == 0.8
    assert scored(spark, risk=5).m_risk == 1.0


@pytest.mark.parametrize(
    ("aum", "family", "value", "flag"),
    [(20.0, 100.0, 0.25, False), (100.0, 100.0, 0.0, True), (90.0, 100.0, 9.0, False), (5.0, None, 0.0, True)],
)
def test_allocation(spark, aum, family, value, flag):
    row = scored(spark, aum=aum, family=family)
    assert (row.m_alloc, row.alloc_undefined) == (value, flag)


@pytest.mark.parametrize(("diff", "value"), [(None, 0), (0.0, 0), (-1.0, 0), (0.1, 1)])
def test_beats_category(spark, diff, value):
    assert scored(spark, diff=diff).m_diff == value


@pytest.mark.parametrize(
    ("worst", "best", "value", "flag"),
    [(None, 4.0, 0, False), (0.0, 4.0, 0, False), (-2.0, 4.0, 0, False), (1.0, 4.0, 0.25, False),
     (1.0, 0.0, 0, True), (1.0, None, 0, True)],
)
def test_volatility(spark, worst, best, value, flag):
    row = scored(spark, worst=worst, best=best)
    assert (row.m_volat, row.volat_undefined) == (value, flag)


def test_labels(spark):
    tie = scored(spark, risk=5, rating=2.5, aum=0.0, diff=1.0)
    assert (tie.mean_score, tie.label, tie.label_bin) == (0.5, 1.0, 1)
    large = scored(spark, risk=5, rating=5.0, aum=90.0, diff=1.0)
    assert (large.mean_score, large.label, large.label_bin) == (2.4, 2.0, 1)
    negative = scored(spark, aum=400.0, family=300.0)
    assert (negative.label, negative.label_bin) == (-1.0, 0)


def wide_frame(spark):
    rows = [(1, "a", 2.0), (2, "a", 4.0), (3, "a", None), (4, None, 7.0), (5, "b", None)]
    names = ", ".join(f"double(r) AS fund_ret_{h}" for h in HORIZONS)
    df = spark.createDataFrame(rows, "scheme_idx long, category string, r double")
    return df.selectExpr("scheme_idx", "category", *names.split(", "))


def with_stats(wide):
    return schemes.add_category_benchmarks(wide, schemes.category_benchmarks(wide))


def test_category_benchmarks(spark):
    found = with_stats(wide_frame(spark)).orderBy("scheme_idx").collect()
    got = [(r.cat_avg_3m, r.cat_best_3m, r.cat_worst_3m, r.diff_3m) for r in found]
    assert got == [(3, 4, 2, -1), (3, 4, 2, 1), (3, 4, 2, None), (7, 7, 7, 0), (None,) * 4]


def test_pivot_inverts_unpivot(spark):
    wide = with_stats(wide_frame(spark)).drop("category")
    cells = reshape.performance_cells(wide, ["scheme_idx"])
    back = reshape.performance_wide(cells, ["scheme_idx"]).orderBy("scheme_idx").collect()
    assert back == wide.select("scheme_idx", *measure_columns()).orderBy("scheme_idx").collect()
    rows = [(1, "fund_ret", "1m", "old", 1), (1, "fund_ret", "1m", "new", 2)]
    twice = spark.createDataFrame(rows, "k int, measure string, horizon string, value string, at int")
    assert reshape.performance_wide(twice, ["k"], order="at").first().fund_ret_1m == "new"


def test_by_horizon(spark):
    long = reshape.by_horizon(with_stats(wide_frame(spark)))
    assert long.count() == 5 * len(HORIZONS)
    row = long.filter("scheme_idx = 1 AND horizon = '5y'").first()
    assert (row.fund_ret, row.cat_avg, row.diff, row.ret_1m) == (2, 3, -1, 2)


def test_numbers_of_raw_text(spark):
    raw = {"scheme_risk_text": "Low", "scheme_aum": None, "family_aum": "Rs. 1,000.5", "crisil_rating": "Rank 2",
           "latest_nav": "x", "1yr_return": "--", "scheme_min_investment": "Rs.5", "scheme_last_dividend": None,
           "scheme_bonus": "1:2", "fund_ret_1m": "-1.5%"}
    schema = ", ".join(f"`{c}` string" for c in raw)
    row = schemes.add_numbers(spark.createDataFrame([tuple(raw.values())], schema)).first()
    assert (row.num_scheme_risk, row.num_scheme_aum, row.num_family_aum, row.num_crisil_rating) == (5, 0.0, 1000.5, 2.0)
    assert (row.num_latest_nav, row.num_1yr_return, row.num_min_investment, row.num_bonus) == (None, None, 5.0, 12.0)
    assert row.fund_ret_1m == -1.5


def test_top_families(spark):
    rows = [("c", 5.0), ("a", 5.0), ("b", None), ("d", 9.0)]
    df = spark.createDataFrame(rows, "family_name string, num_family_aum double")
    assert [r[0] for r in schemes.top_families(df, 3).collect()] == ["d", "a", "c"]


def test_rankings(spark):
    rows = [(i, h, v) for h in ("1m", "3m") for i, v in enumerate([1.0, None, 3.0, 3.0, 2.0, None, 0.5, 9.0])]
    df = spark.createDataFrame(rows, "scheme_idx long, horizon string, fund_ret double").repartition(5)
    full = [(r.horizon, r.scheme_idx) for r in ranking.rank_horizons(df).collect()]
    order = [7, 2, 3, 4, 0, 6, 1, 5]
    assert full == [(h, i) for h in ("1m", "3m") for i in order]
    top = ranking.top_per_horizon(df).orderBy("horizon", "rank").collect()
    assert [(r.horizon, r.scheme_idx) for r in top] == [(h, i) for h in ("1m", "3m") for i in order[:5]]
    plan = ranking.top_per_horizon(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_facts_take_one_scan_and_one_shuffle(spark, sf_dir):
    lineitem = binding.table(spark, sf_dir, "lineitem")
    facts = binding.scheme_facts(lineitem, binding.last_ship_date(lineitem))
    plan = facts._jdf.queryExecution().executedPlan().toString()
    assert (plan.count("Exchange hashpartitioning"), plan.count("FileScan")) == (1, 1)


def test_train_split(spark):
    df = spark.range(1296).withColumnRenamed("id", "scheme_idx")
    flagged = ranking.add_train_flag(df, df)
    assert flagged.filter("is_train").count() == 1000
    assert flagged.filter("is_train").agg(F.max("scheme_idx")).first()[0] == 999
