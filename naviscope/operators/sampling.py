"""Samples of exact size and class weights."""

import math

from pyspark.sql import functions as F

from naviscope.operators.scan import add_row_number
from naviscope.session import materialise

# Chunks of a stratum's sample, by hash.
CHUNKS = 64
HASH_BITS = 60


def sample_exactly(rows, by, k, key, seed=0):
    """`k` rows of each stratum, all where it has fewer: those whose key columns have the least hashes.

    The same rows come whatever the partitions. Only rows below a hash limit that lets slightly more
    than `k` through are shuffled; where it let too few through it is raised for that stratum. Rows
    of equal hash are ordered by their key, equal keys arbitrarily. Null strata are strata.
    """
    digits = F.substr(F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key])), F.lit(1), F.lit(HASH_BITS // 4))
    hashed = rows.withColumn("__hash", F.conv(digits, 16, 10).cast("long"))
    hashed = hashed.withColumn("__stratum", F.struct(*by))
    sizes = hashed.groupBy("__stratum").agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("__stratum", "__of")
    sizes = materialise(sizes.withColumn("allowed", F.lit(k + 6 * math.sqrt(k) + 10)), "strata")
    while True:
        # One row per stratum, stored: its size decides how it is joined.
        limit = F.when(F.col("allowed") >= F.col("n"), F.lit(float(2**HASH_BITS))).otherwise(F.col("allowed") / F.col("n") * float(2**HASH_BITS))
        limits = sizes.select("__of", "n", "allowed", limit.alias("__limit"))
        chosen = hashed.join(limits.select("__of", "__limit"), F.col("__stratum") == F.col("__of")).where(F.col("__hash") <= F.col("__limit")).drop("__of")
        held = chosen.groupBy("__stratum").agg(F.count(F.lit(1)).alias("held"))
        short = sizes.join(held, F.col("__of") == F.col("__stratum"), "left")
        short = short.withColumn("short", F.coalesce("held", F.lit(0)) < F.least(F.lit(k), F.col("n")))
        if not short.where("short").limit(1).count():
            break
        raised = F.when(F.col("short"), 2 * F.col("allowed")).otherwise(F.col("allowed"))
        sizes = materialise(short.select("__of", "n", raised.alias("allowed")), "strata")
    # Chunks are ranges of the hash below its stratum's limit: about equal, and in order.
    chosen = chosen.withColumn("__chunk", F.least(F.floor(F.col("__hash") / F.col("__limit") * CHUNKS), F.lit(CHUNKS)))
    numbered = add_row_number(chosen, ["__stratum"], "__chunk", ["__hash", *key], "__number")
    return numbered.where(F.col("__number") <= k).select(*rows.columns)


def class_weights(rows, by, label, name="weight"):
    """`rows` with a weight that makes the classes of each group weigh the same, and all rows their number.

    A group with one class has weights of 1.
    """
    counts = rows.groupBy(*by, label).agg(F.count(F.lit(1)).alias("__n"))
    totals = counts.groupBy(*by).agg(F.sum("__n").alias("__total"), F.count(F.lit(1)).alias("__classes"))
    same = lambda a, b, names: [a[c].eqNullSafe(b[f"__{c}"]) for c in names]
    totals = totals.select(*[F.col(c).alias(f"__{c}") for c in by], "__total", "__classes")
    weights = counts.join(totals, same(counts, totals, by))
    weights = weights.select(*[F.col(c).alias(f"__{c}") for c in (*by, label)], (F.col("__total") / (F.col("__classes") * F.col("__n"))).alias(name))
    weights = materialise(weights, "class-weights")
    return rows.join(weights, same(rows, weights, (*by, label))).select(*rows.columns, name)
