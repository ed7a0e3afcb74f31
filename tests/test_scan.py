import random

import pytest
from pyspark.sql import functions as F

from naviscope.operators.scan import add_chunk, add_ntile, add_row_number, add_running_sum, position_chunk


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    ids = rng.sample(range(5000), 700)
    # One key holds most rows, one is null.
    keys = rng.choices(["hot", "a", "b", None], [20, 2, 2, 1], k=len(ids))
    data = [(k, i, rng.randint(0, 9)) for k, i in zip(keys, ids)]
    df = spark.createDataFrame(data, "k string, i long, v int")
    return data, df.withColumn("chunk", position_chunk("i", 64))


def test_chunks_of_small_keys(spark):
    # One key holds half of the rows; 500 others have two rows each, far apart, and one is null.
    data = [("hot", i) for i in range(0, 2000, 2)] + [(str(i % 500) if i % 500 else None, 2 * i + 1) for i in range(1000)]
    df = spark.createDataFrame(data, "k string, i long")
    out = add_chunk(df, ["k"], "i", rows=100)
    assert out.count() == len(data) and out.columns == ["k", "i", "chunk"]
    assert out.select("k", "chunk").distinct().count() == 20 + 500
    assert max(r["count"] for r in out.groupBy("k", "chunk").count().collect()) <= 100
    found = {r.i: r.n for r in add_row_number(out, ["k"], "chunk", ["i"], "n").collect()}
    assert all(found[i] == i // 2 + 1 for i in range(0, 2000, 2))


def test_row_number(rows):
    data, df = rows
    found = {r.i: (r.n, r.t) for r in add_row_number(df, ["k"], "chunk", ["i"], "n", "t").collect()}
    for key in {k for k, _, _ in data}:
        mine = sorted(i for k, i, _ in data if k == key)
        for n, i in enumerate(mine, start=1):
            assert found[i] == (n, len(mine))


@pytest.mark.parametrize("tiles", [1, 7, 10, 100])
def test_ntile(spark, rows, tiles):
    _, df = rows
    df.createOrReplaceTempView("ntile_rows")
    wanted = spark.sql(f"SELECT i, ntile({tiles}) OVER (PARTITION BY k ORDER BY i) AS t FROM ntile_rows")
    found = add_ntile(df, ["k"], "chunk", ["i"], tiles, "t").select("i", "t")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))


def test_running_sum(spark, rows):
    _, df = rows
    df.createOrReplaceTempView("sum_rows")
    wanted = spark.sql(
        "SELECT i, sum(v) OVER (PARTITION BY k ORDER BY i) AS s, sum(v) OVER (PARTITION BY k) AS t FROM sum_rows"
    )
    found = add_running_sum(df, ["k"], "chunk", ["i"], {"s": (F.col("v"), "t")}).select("i", "s", "t")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))
