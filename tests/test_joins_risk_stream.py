import math
import statistics

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from naviscope.operators import joins, risk
from naviscope.streaming import feed_stream

HEAD = "Code;A;B;Scheme Name\n"


def test_lookup(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "i int, k string")
    dim = spark.createDataFrame([("a", "A")], "d string, v string")
    found = {r.i: r.v for r in joins.lookup(left, dim, "k", "d").collect()}
    assert found == {1: "A", 2: None, 3: None}
    assert sorted(r.i for r in joins.unmatched(left, dim, "k", "d").collect()) == [2, 3]
    with pytest.raises(PySparkException, match="unknown key"):
        joins.lookup(left, dim, "k", "d", strict=True).collect()


def test_name_matches_do_not_multiply(spark):
    left = spark.createDataFrame([(i, "x" if i % 3 else "y") for i in range(30)], "i int, n string")
    right = spark.createDataFrame([(j, "X") for j in range(50)], "id int, n string")
    found = joins.name_matches(left, right, [F.col("n")], [F.lower("n")], "id").collect()
    assert len(found) == 30
    assert {(r.n, r.id, r.n_candidates) for r in found} == {("x", None, 50), ("y", None, None)}
    assert sorted(r.id for r in joins.ambiguous_names(right, {"n": F.lower("n")}, "id").collect()) == list(range(50))
    one = joins.name_matches(left, right.limit(1), [F.col("n")], [F.lower("n")], "id").filter("n = 'x'").first()
    assert one.id is not None and one.n_candidates == 1


def test_risk_measures(spark):
    ret = [1.0, -2.0, 3.0, 0.5, 4.0, -1.0]
    bench = [0.5, -1.0, 2.0, 1.0, 2.5, -2.0]
    schema = "k int, c string, month int, {0} {1}"
    series = spark.createDataFrame([(1, "c", i, v) for i, v in enumerate(ret)], schema.format("ret", "double"))
    market = spark.createDataFrame([("c", i, v) for i, v in enumerate(bench)], "c string, month int, bench double")
    row = risk.risk_measures(series, market, "k", ["c"], "month", risk_free=0.1).first()
    excess = [r - 0.1 for r in ret]
    mean = statistics.mean(excess)
    slope, intercept = statistics.linear_regression(bench, ret)
    assert row.mean_excess == pytest.approx(mean)
    assert row.std_dev == pytest.approx(statistics.stdev(ret))
    assert row.sharpe == pytest.approx(mean / statistics.stdev(ret))
    assert row.sortino == pytest.approx(mean / math.sqrt(statistics.mean(min(e, 0) ** 2 for e in excess)))
    assert (row.beta, row.alpha) == (pytest.approx(slope), pytest.approx(intercept))
    assert row.r_squared == pytest.approx(statistics.correlation(bench, ret) ** 2)
    assert row.treynor == pytest.approx(mean / slope)
    assert row.up_capture == pytest.approx(8.5 / 6) and row.down_capture == pytest.approx(1.0)
    short = risk.risk_measures(series.filter("month = 0"), market, "k", ["c"], "month").first()
    assert (short.n_periods, short.mean_excess, short.std_dev, short.sharpe) == (1, 1.0, None, None)


def test_period_returns_and_benchmark(spark):
    rows = [(1, 1, 10.0), (1, 3, 15.0), (2, 1, 0.0), (2, 2, 5.0)]
    prices = spark.createDataFrame(rows, "k int, month int, price double")
    found = risk.period_returns(prices, ["k"], "month", "price").collect()
    assert [(r.k, r.month, float(r.ret)) for r in found] == [(1, 3, 50.0)]


def test_incremental_ingest(spark, tmp_path):
    source, target, state = (str(tmp_path / d) for d in ("in", "out", "state"))
    (tmp_path / "in").mkdir()
    dimension = spark.createDataFrame([("F", "7")], "family string, family_id string")
    names = ["Code", "A", "B", "Scheme Name"]

    def run(name, body):
        (tmp_path / "in" / name).write_text(HEAD + body)
        feed_stream.ingest(spark, source, target, state, dimension, names)
        rows = spark.read.parquet(f"{target}/rows")
        return sorted((r.code, r.scheme_type, r.fund_family, r.fund_id) for r in rows.collect())

    first = run("a.txt", "T (C)\nF\n1;a;b;X\nbad;row\n")
    assert first == [("1", "T ", "F", "7")]
    assert [r.line for r in spark.read.parquet(f"{target}/rejects").collect()] == ["bad;row"]
    # A second file starts without the first one's context, and the first is not read again.
    assert run("b.txt", "G\n2;a;b;Y\n") == [("1", "T ", "F", "7"), ("2", None, "G", None)]
