"""Risk measures of a return series against a benchmark series."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from naviscope.session import materialise


def period_returns(prices, keys, period, price):
    """Return over the previous period the key has a price for, in percent.

    Four decimals, kept as a decimal so that sums do not depend on row order.
    `prices` holds one row per key and period, so a key's window is as long as
    the calendar, not as the data.
    """
    w = Window.partitionBy(*keys).orderBy(period)
    growth = F.try_divide(F.col(price), F.lag(price).over(w))
    return prices.withColumn("ret", F.round((growth - 1) * 100, 4).cast("decimal(18,4)")).filter("ret IS NOT NULL")


def benchmark_returns(returns, by, period):
    """Mean return of each group and period."""
    return returns.groupBy(*by, period).agg((F.sum("ret").cast("double") / F.count("ret")).alias("bench"))


def risk_measures(returns, benchmark, key, by, period, risk_free=0.0):
    """One row per key, however short its series; what a series does not define is null."""
    r = f"(ret - {risk_free}D)"
    joined = returns.join(benchmark, [*by, period])
    joined = joined.withColumn("exact", F.col("ret")).withColumn("ret", F.col("ret").cast("double"))
    stats = joined.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_periods"),
        F.expr(f"double(sum(exact)) / count(exact) - {risk_free}D").alias("mean_excess"),
        F.expr("stddev_samp(ret)").alias("std_dev"),
        F.expr(f"sqrt(avg(least({r}, 0D) * least({r}, 0D)))").alias("downside"),
        F.expr("regr_r2(ret, bench)").alias("r_squared"),
        F.expr("regr_slope(ret, bench)").alias("beta"),
        F.expr("regr_intercept(ret, bench)").alias("alpha"),
        F.expr("try_divide(avg(CASE WHEN bench > 0 THEN ret END), avg(CASE WHEN bench > 0 THEN bench END))").alias("up_capture"),
        F.expr("try_divide(avg(CASE WHEN bench < 0 THEN ret END), avg(CASE WHEN bench < 0 THEN bench END))").alias("down_capture"),
    )
    return stats.selectExpr(
        key,
        "n_periods",
        "mean_excess",
        "std_dev",
        "try_divide(mean_excess, std_dev) AS sharpe",
        "try_divide(mean_excess, downside) AS sortino",
        "r_squared",
        "beta",
        "alpha",
        "try_divide(mean_excess, beta) AS treynor",
        "up_capture",
        "down_capture",
    )


# What a month adds to a scheme: sums of its return r, the benchmark's b, their squares and product,
# and of both in rising and falling months. Exact decimals, so that months add up in any order.
_TERMS = {
    "n": "1L",
    "sum_r": "ret",
    "sum_low": "least(ret - {rf}, 0) * least(ret - {rf}, 0)",
    "sum_rr": "ret * ret",
    "sum_b": "bench",
    "sum_bb": "bench * bench",
    "sum_rb": "ret * bench",
    "n_up": "bigint(bench > 0)",
    "up_r": "if(bench > 0, ret, 0)",
    "up_b": "if(bench > 0, bench, 0)",
    "n_down": "bigint(bench < 0)",
    "down_r": "if(bench < 0, ret, 0)",
    "down_b": "if(bench < 0, bench, 0)",
}


def moments(returns, benchmark, key, by, period, risk_free=0.0):
    """One row per key and period: the terms that `merged_moments` adds up.

    Benchmarks are taken at 16 decimals, products at 20.
    """
    joined = returns.join(benchmark, [*by, period])
    joined = joined.withColumn("ret", F.col("ret").cast("decimal(14,4)")).withColumn("bench", F.col("bench").cast("decimal(22,16)"))
    rf = f"cast({risk_free} AS decimal(14,4))"
    terms = [F.expr(e if e.endswith("L") or "bigint" in e else f"cast({e.format(rf=rf)} AS decimal(38,20))").alias(n) for n, e in _TERMS.items()]
    return joined.select(key, period, *terms)


def merged_moments(rows, key):
    """Moments of the same key added up: of months, or of sums of months."""
    return rows.groupBy(key).agg(*[F.sum(n).alias(n) for n in _TERMS])


def measures_of(merged, key, risk_free=0.0):
    """`risk_measures` from merged moments.

    Sums about the means are exact before they become doubles; sums too large for that, which 38
    digits can't multiply, are multiplied as doubles.
    """
    # Types that leave products of 38 digits their decimals.
    many = lambda c, t: f"try_cast({c} AS {t})"
    about = lambda a, x, y, types: f"coalesce(double({many('n', 'decimal(9,0)')} * {many(a, 'decimal(28,20)')} - {many(x, types[0])} * {many(y, types[1])}), n * double({a}) - double({x}) * double({y})) / n"
    ret, bench = "decimal(14,4)", "decimal(22,16)"
    exact = merged.selectExpr(
        key,
        "n",
        "double(sum_r) / n AS mean_r",
        "double(sum_b) / n AS mean_b",
        "double(sum_low) AS sum_low",
        f"{about('sum_rr', 'sum_r', 'sum_r', (ret, ret))} AS rr",
        f"{about('sum_bb', 'sum_b', 'sum_b', (bench, bench))} AS bb",
        f"{about('sum_rb', 'sum_r', 'sum_b', (ret, bench))} AS rb",
        "try_divide(try_divide(double(up_r), n_up), try_divide(double(up_b), n_up)) AS up_capture",
        "try_divide(try_divide(double(down_r), n_down), try_divide(double(down_b), n_down)) AS down_capture",
    )
    return exact.selectExpr(
        key,
        "n AS n_periods",
        f"mean_r - {risk_free}D AS mean_excess",
        "if(n > 1, sqrt(greatest(rr, 0D) / (n - 1)), null) AS std_dev",
        "sqrt(sum_low / n) AS downside",
        "if(n > 1, try_divide(rb, bb), null) AS beta",
        "if(n > 1, if(bb > 0 AND rr = 0, 1D, try_divide(rb * rb, bb * rr)), null) AS r_squared",
        "mean_r",
        "mean_b",
        "up_capture",
        "down_capture",
    ).selectExpr(
        key,
        "n_periods",
        "mean_excess",
        "std_dev",
        "try_divide(mean_excess, std_dev) AS sharpe",
        "try_divide(mean_excess, downside) AS sortino",
        "r_squared",
        "beta",
        "mean_r - beta * mean_b AS alpha",
        "try_divide(mean_excess, beta) AS treynor",
        "up_capture",
        "down_capture",
    )


class MomentStore:
    """Moments per key and period in a folder that grows by periods.

    `{path}/moments` holds a partition a period, `{path}/last` a partition a period with every key's
    last price up to then. A period is computed from its own prices and the last prices before it;
    computed again, it replaces its partitions.
    """

    def __init__(self, spark, path, key, by, period, price, risk_free=0.0):
        self.spark, self.path, self.key, self.by, self.period, self.price, self.risk_free = spark, path, key, by, period, price, risk_free

    def _write(self, df, name):
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.period).parquet(f"{self.path}/{name}")

    def load(self, prices, groups):
        """All periods of `prices` (one row per key and period); `groups` gives each key's benchmark group."""
        returns = period_returns(prices, [self.key], self.period, self.price)
        self._add(returns.join(groups, self.key))
        latest = prices.agg(F.max(self.period)).first()[0]
        last = prices.groupBy(self.key).agg(F.max_by(self.price, self.period).alias(self.price))
        self._write(last.withColumn(self.period, F.lit(latest)), "last")

    def add(self, prices, groups, period, before):
        """One more period; `prices` holds no other, `before` is the period of the last prices."""
        known = self.spark.read.parquet(f"{self.path}/last").where(F.col(self.period) == F.lit(before))
        known = known.select(F.col(self.key).alias("__key"), F.col(self.price).alias("__price"))
        new = materialise(prices.select(self.key, self.price), "period-prices")
        both = new.join(known, F.col(self.key) == F.col("__key"), "full")
        growth = F.try_divide(F.col(self.price), F.col("__price"))
        returns = both.withColumn("ret", F.round((growth - 1) * 100, 4).cast("decimal(18,4)")).where("ret IS NOT NULL")
        self._add(returns.select(self.key, "ret", F.lit(period).alias(self.period)).join(groups, self.key))
        last = both.select(F.coalesce(self.key, "__key").alias(self.key), F.coalesce(self.price, "__price").alias(self.price))
        self._write(last.withColumn(self.period, F.lit(period)), "last")

    def _add(self, returns):
        # Stored: the benchmark and the moments both start from it.
        returns = materialise(returns.select(self.key, *self.by, self.period, "ret"), "returns")
        bench = materialise(benchmark_returns(returns, self.by, self.period), "benchmark")
        self._write(moments(returns, bench, self.key, self.by, self.period, self.risk_free), "moments")

    def measures(self):
        stored = self.spark.read.parquet(f"{self.path}/moments")
        return measures_of(merged_moments(stored, self.key), self.key, self.risk_free)
