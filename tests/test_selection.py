"""Exact quantiles, exact samples, weights and ROC areas."""

import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from naviscope.operators import evaluate, quantiles, sampling

SHARES = (0, 0.1, 0.25, 0.5, 0.75, 0.999, 1)


def value_sets():
    rng = random.Random(6)
    return {
        "normal": [rng.gauss(0, 1) for _ in range(2001)],
        "equal": [1.5] * 500,
        "one": [7.0],
        "two": [1.0, 2.0],
        "piled": [0.1] * 900 + [0.1 + i * 1e-17 for i in range(5)] + [1e9],
        "wide": [(-1) ** i * 10.0**e for i in range(2) for e in range(-300, 300, 7)],
        "huge": [-1.7e308, 1.7e308, 0.0, -0.0, 5e-324],
        "none": [None] * 5,
        None: [3.0, None, 1.0],
    }


@pytest.mark.parametrize("buckets", [1024, 3])
def test_quantiles_equal_sorting(spark, buckets, monkeypatch):
    monkeypatch.setattr(quantiles, "BUCKETS", buckets)
    sets = value_sets()
    if buckets == 3:
        sets = {k: v[:12] for k, v in sets.items()}
    rows = [(k, v, "clash") for k, values in sets.items() for v in values]
    df = spark.createDataFrame(rows, "g string, v double, n string").repartition(5)
    found = {r["g"]: (r["n"], r["quantiles"]) for r in quantiles.exact_quantiles(df.select("g", "v"), ["g"], "v", SHARES).collect()}
    wanted = {k: sorted(x for x in v if x is not None) for k, v in sets.items()}
    wanted = {k: v for k, v in wanted.items() if v}
    assert found.keys() == wanted.keys()
    for k, (n, values) in found.items():
        assert n == len(wanted[k])
        for p, v in zip(SHARES, values):
            place = p * (n - 1)
            low, high = wanted[k][int(place)], wanted[k][min(int(np.ceil(place)), n - 1)]
            # Neighbours further apart than any double have no exact mean.
            assert v == pytest.approx(low + (high - low) * (place - int(place)), rel=1e-12) or high - low == float("inf")


def test_quantiles_need_no_list_of_a_group(spark):
    df = spark.range(200_000).selectExpr("id % 2 AS g", "(id * 7919) % 200000 / 3 AS v")
    found = {r["g"]: r["quantiles"] for r in quantiles.exact_quantiles(df, ["g"], "v", (0.25, 0.5, 0.75)).collect()}
    values = {g: sorted((i * 7919) % 200000 / 3 for i in range(g, 200_000, 2)) for g in (0, 1)}
    for g, v in values.items():
        assert found[g] == pytest.approx(statistics.quantiles(v, n=4, method="inclusive"), rel=1e-12)
    plan = quantiles.order_statistics(df, ["g"], "v", quantiles._targets((0.5,)))
    assert plan.count() == 2


def test_box_plots_of_large_groups_are_the_same(spark):
    rng = random.Random(2)
    df = spark.createDataFrame([(g, rng.choice((rng.random(), 5.0, None))) for g in "ab" for _ in range(400)], "horizon string, f1 double")
    both = [sorted(map(tuple, evaluate.box_plot(df, ["horizon"], large_groups=large).collect())) for large in (False, True)]
    assert both[0] == both[1]
    assert evaluate.box_plot(df.limit(0), ["horizon"], large_groups=True).count() == 0
    with pytest.raises(ValueError):
        quantiles.exact_quantiles(df, ["horizon"], "f1", (1.5,))


@pytest.mark.parametrize("large", [False, True])
def test_box_plots_do_not_gather_a_group(spark, large):
    df = spark.range(2_000_000).selectExpr("id % 3 AS g", "double(id % 1001) AS v", "id AS other")
    assert [tuple(r) for r in evaluate.box_plot(df, ["g"], "v", large).orderBy("g").collect()] == [(g, 250.0, 500.0, 750.0, 0.0, 1000.0, 0) for g in range(3)]
    plan = evaluate.box_plot(df, ["g"], "v", large)
    plan = plan._sc._jvm.PythonSQLUtils.explainString(plan._jdf.queryExecution(), "formatted")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_samples_have_their_size_whatever_the_partitions(spark):
    rows = [(i, "big" if i % 3 else None, i % 7, "x") for i in range(5000)] + [(9000 + i, "small", 0, "x") for i in range(4)]
    df = spark.createDataFrame(rows, "id long, s string, n long, other string")
    chosen = [sorted(r["id"] for r in sampling.sample_exactly(df.repartition(p), ["s"], 100, ["id"]).collect()) for p in (1, 7)]
    assert chosen[0] == chosen[1]
    sizes = {r["s"]: r["count"] for r in df.where(F.col("id").isin(chosen[0])).groupBy("s").count().collect()}
    assert sizes == {"big": 100, None: 100, "small": 4}
    assert sampling.sample_exactly(df, ["s"], 100, ["id"]).columns == df.columns
    other = {r["id"] for r in sampling.sample_exactly(df, ["s"], 100, ["id"], seed=1).collect()}
    assert len(other) == 204 and other != set(chosen[0])


def test_samples_of_repeated_rows_and_a_limit_that_is_too_low(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a")] * 50 + [(2, "a")] * 50, "id long, s string")
    assert sampling.sample_exactly(df, ["s"], 60, ["id"]).count() == 60
    monkeypatch.setattr(sampling.math, "sqrt", lambda k: -k / 6)
    assert sampling.sample_exactly(spark.range(3000).selectExpr("id", "'a' AS s"), ["s"], 200, ["id"]).count() == 200
    assert sampling.sample_exactly(df.limit(0), ["s"], 3, ["id"]).count() == 0


def test_class_weights(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("a", 0), ("a", 0), ("b", 0), (None, 1), (None, None)], "horizon string, label_bin int")
    found = sorted(map(tuple, sampling.class_weights(df, ["horizon"], "label_bin").collect()), key=str)
    third = 4 / 6
    assert found == sorted([("a", 1, 2.0), *[("a", 0, third)] * 3, ("b", 0, 1.0), (None, 1, 1.0), (None, None, 1.0)], key=str)


def test_roc_of_piled_up_scores(spark):
    # 20,000 distinct scores within 0.001, which spread over all tasks all the same.
    df = spark.range(20_000).selectExpr("'1m' AS horizon", "0.5 + id * 5e-8 AS score", "int(id % 10 < 3 OR id > 15000) AS label_bin")
    sums = evaluate._roc_sums(df, "score", "label_bin")
    ranges = df.groupBy("score").count().repartitionByRange(8, F.col("score").desc()).groupBy(F.spark_partition_id()).count().collect()
    assert len(ranges) == 8 and max(r["count"] for r in ranges) < 2 * 20_000 / 8
    rows = sorted(df.collect(), key=lambda r: -r["score"])
    tp = np.cumsum([r["label_bin"] for r in rows])
    fp = np.cumsum([1 - r["label_bin"] for r in rows])
    assert [(r["tp"], r["fp"]) for r in sorted(sums.collect(), key=lambda r: -r["score"])] == list(zip(tp.tolist(), fp.tolist()))
    area = np.trapezoid(np.r_[0, tp] / tp[-1], np.r_[0, fp] / fp[-1])
    assert evaluate.roc_area(df).first()["area"] == pytest.approx(area, rel=1e-12)
    one = spark.createDataFrame([("1m", 0.5, 1), ("1m", 0.5, 1)], "horizon string, score double, label_bin int")
    assert evaluate.roc_area(one).first()["area"] is None
