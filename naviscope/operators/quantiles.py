"""Exact quantiles of groups of any size, by selection.

An order statistic is found by passes over the values: a histogram of the range that holds its
rank says in which bucket it lies, and the least and greatest value of that bucket are the next
range, until they are equal. What a pass hands on is one row per group, range and bucket; no group
is sorted or held.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from naviscope.session import materialise

BUCKETS = 1024


def _key(by):
    """The group columns as one struct, in which nulls are values like any other."""
    return F.struct(*by).alias("__at")


def _targets(probabilities):
    """The ranks (from 0) needed to interpolate each probability: [(floor, ceiling)] as expressions of n."""
    place = [F.lit(float(p)) * (F.col("n") - 1) for p in probabilities]
    return F.array_sort(F.array_distinct(F.array(*[f(x).cast("long") for x in place for f in (F.floor, F.ceil)])))


def _share(v, low, high):
    """How far v lies in a range, 0..1: by sign where the range holds 0, by exponent where it spans many, else evenly."""
    positive, negative = F.log(v) - F.log(low), F.log(-low) - F.log(-v)
    return (
        F.when((low <= 0) & (high >= 0), (F.signum(v) + 1) / 3)
        .when((low > 0) & (high / 1024 > low), positive / (F.log(high) - F.log(low)))
        .when((high < 0) & (low / 1024 < high), negative / (F.log(-low) - F.log(-high)))
        .otherwise((v - low) / (high - low))
    )


def order_statistics(rows, by, value, ranks, buckets=None):
    """(__at, ranks, found): the values at each group's `ranks` (an array expression of its count n), null values left out.

    `rows` is read once a pass and should be stored.
    """
    buckets = buckets or BUCKETS
    rows = rows.where(F.col(value).isNotNull()).select(_key(by), F.col(value).cast("double").alias("v"))
    groups = rows.groupBy("__at").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    each = groups.select("__at", F.explode(ranks).alias("rank"), "low", "high", F.col("rank").alias("within"))
    each = materialise(each, "ranks")
    done = each.where("low = high")
    while each.where("low < high").limit(1).count():
        open_ = each.where("low < high")
        ranges = open_.groupBy("__at").agg(F.array_sort(F.collect_set(F.struct("low", "high"))).alias("ranges"))
        # As many rows as groups, stored: their size decides how they are joined.
        ranges = materialise(ranges.withColumnRenamed("__at", "__of"), "ranges")
        held = rows.join(ranges, F.col("__at") == F.col("__of")).select("__at", "v", F.explode(F.filter("ranges", lambda r: F.col("v").between(r.low, r.high))).alias("r"))
        # The greatest value has a bucket of its own, so that a pass always narrows the range.
        share = _share(F.col("v"), F.col("r.low"), F.col("r.high"))
        bucket = F.when(F.col("v") == F.col("r.high"), F.lit(buckets)).otherwise(F.least(F.floor(share * buckets), F.lit(buckets - 1)).cast("int"))
        counts = held.groupBy("__at", F.col("r.low").alias("low"), F.col("r.high").alias("high"), bucket.alias("bucket"))
        counts = counts.agg(F.count(F.lit(1)).alias("m"), F.min("v").alias("next_low"), F.max("v").alias("next_high"))
        # At most `buckets` + 1 rows per range.
        before = Window.partitionBy("__at", "low", "high").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("before", F.coalesce(F.sum("m").over(before), F.lit(0)))
        found = open_.join(counts, ["__at", "low", "high"]).where((F.col("before") <= F.col("within")) & (F.col("within") < F.col("before") + F.col("m")))
        found = found.select("__at", "rank", F.col("next_low").alias("low"), F.col("next_high").alias("high"), (F.col("within") - F.col("before")).alias("within"))
        each = materialise(found.unionByName(done), "ranks")
        done = each.where("low = high")
    return each.groupBy("__at").agg(F.map_from_entries(F.collect_list(F.struct("rank", "low"))).alias("found"), F.max("rank").alias("__last"))


def exact_quantiles(rows, by, value, probabilities):
    """Per group its count and `quantiles`, one per probability, interpolated between neighbours.

    Null values don't count; a group of nulls only has no row. Null keys are a group. -0.0 is 0.0;
    NaN isn't allowed.
    """
    if not all(0 <= p <= 1 for p in probabilities):
        raise ValueError("probabilities lie in 0..1")
    rows = materialise(rows.select(*by, (F.col(value).cast("double") + 0.0).alias(value)), "values")
    found = order_statistics(rows, by, value, _targets(probabilities))
    counts = rows.where(F.col(value).isNotNull()).groupBy(_key(by)).agg(F.count(F.lit(1)).alias("n"))
    out = counts.withColumnRenamed("__at", "__of").join(found, F.col("__of") == F.col("__at"))

    def quantile(p):
        place = F.lit(float(p)) * (F.col("n") - 1)
        low, high = (F.element_at("found", f(place).cast("long")) for f in (F.floor, F.ceil))
        return low + (high - low) * (place - F.floor(place))

    return out.select("__at.*", "n", F.array(*map(quantile, probabilities)).alias("quantiles"))
