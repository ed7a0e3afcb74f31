"""Folds and scores of predictions."""

from pyspark.sql import functions as F

from naviscope.operators.quantiles import exact_quantiles
from naviscope.operators.scan import CHUNK_ROWS, add_ntile, add_running_sum, position_chunk
from naviscope.session import materialise


def add_folds(rows, folds=10, key="scheme_idx", label="label_bin", chunk_rows=CHUNK_ROWS):
    """Stratified fold 0..folds-1: consecutive runs of each label by position."""
    chunked = rows.withColumn("__chunk", position_chunk(key, chunk_rows))
    tiled = add_ntile(chunked, ["horizon", label], "__chunk", [key], folds, "fold")
    return tiled.withColumn("fold", F.col("fold") - 1).drop("__chunk")


def confusion(rows, by, prediction="prediction", label="label_bin", weight=None):
    """True and false positives, false and true negatives per group.

    `weight` names a count column of rows that were aggregated before.
    """
    w = weight or "1L"

    def count(p, y):
        return F.expr(f"sum(CASE WHEN {prediction} = {p} AND {label} = {y} THEN {w} ELSE 0L END)")

    return rows.groupBy(*by).agg(
        count(1, 1).alias("tp"),
        count(1, 0).alias("fp"),
        count(0, 1).alias("fn"),
        count(0, 0).alias("tn"),
    )


def _share(part, whole):
    return F.coalesce(F.try_divide(F.expr(part).cast("double"), F.expr(whole)), F.lit(0.0))


def f1_scores(rows, by, **columns):
    """F1 of the good class per group, 0 where there is nothing to score."""
    return confusion(rows, by, **columns).select(*by, _share("2 * tp", "2 * tp + fp + fn").alias("f1"))


def precision_recall(rows, by, **columns):
    return confusion(rows, by, **columns).select(
        *by,
        "tp",
        "fp",
        "fn",
        "tn",
        _share("tp", "tp + fp").alias("precision"),
        _share("tp", "tp + fn").alias("recall"),
    )


def accuracy(rows, by=("horizon",), prediction="prediction", label="label_bin"):
    """Share of right predictions, next to the share of the larger class."""
    return rows.groupBy(*by).agg(
        F.expr(f"avg(CASE WHEN {prediction} = {label} THEN 1D ELSE 0D END)").alias("accuracy"),
        F.expr(f"greatest(avg(double({label})), 1 - avg(double({label})))").alias("majority_share"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def expand_levels(counts, levels, level="level", prediction="prediction", out="num_trees"):
    """Grid 1..levels from counts per level: positive at every step up to `level`.

    Works on aggregated counts, so the grid multiplies groups and not rows.
    """
    grid = counts.withColumn(out, F.explode(F.sequence(F.lit(1), F.lit(levels))))
    return grid.withColumn(prediction, (F.col(level) >= F.col(out)).cast("int"))


def box_plot(scores, by, value="f1", large_groups=False):
    """Quartiles, whiskers within 1.5 box heights, and outliers per group.

    `scores` is read twice. Exact quartiles hold the distinct values of a group, not its rows;
    with `large_groups` they hold neither, but take a few passes more.
    """
    if large_groups:
        q = exact_quantiles(scores, by, value, (0.25, 0.5, 0.75)).withColumnRenamed("quantiles", "__q")
    else:
        q = scores.groupBy(*by).agg(F.percentile(value, F.array(*map(F.lit, (0.25, 0.5, 0.75)))).alias("__q"))
    # Stored, its size decides how it is joined: few groups are broadcast, and no group's rows meet in one task.
    q = materialise(q.select(*[F.col(c).alias(f"__{c}") for c in by], "__q"), "quartiles")
    on = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by]
    q1, median, q3 = (F.col("__q")[i] for i in range(3))
    reach = 1.5 * (q3 - q1)
    near = F.col(value).between(q1 - reach, q3 + reach)
    return scores.join(q, on).groupBy(*by).agg(
        F.first(q1).alias("q1"),
        F.first(median).alias("median"),
        F.first(q3).alias("q3"),
        F.min(F.when(near, F.col(value))).alias("whisker_low"),
        F.max(F.when(near, F.col(value))).alias("whisker_high"),
        F.count_if(~near).cast("int").alias("outliers"),
    )


def best_tree_count(scores, value="f1"):
    """Per horizon the tree count with the best mean score, the smaller on a tie."""
    mean = scores.groupBy("horizon", "num_trees").agg(F.round(F.avg(value), 6).alias("mean_f1"))
    rank = F.struct(F.col("mean_f1"), -F.col("num_trees"))
    best = mean.groupBy("horizon").agg(F.max_by(F.struct("num_trees", "mean_f1"), rank).alias("b"))
    return best.select("horizon", "b.num_trees", "b.mean_f1")


def _roc_sums(rows, score, label):
    """(horizon, score, p, n, tp, fp, positives, negatives): counts at each distinct score, and of all as high or higher."""
    counts = rows.groupBy("horizon", score).agg(
        F.sum(label).cast("long").alias("p"),
        F.sum(1 - F.col(label)).cast("long").alias("n"),
    )
    # Ranges cut at sampled quantiles are about equal however the scores pile up. Stored, so that they stay.
    ranged = counts.repartitionByRange("horizon", F.col(score).desc()).withColumn("__chunk", F.spark_partition_id())
    counts = materialise(ranged, "score-ranges")
    sums = {"tp": (F.col("p"), "positives"), "fp": (F.col("n"), "negatives")}
    return add_running_sum(counts, ["horizon"], "__chunk", [F.col(score).desc()], sums)


def roc_points(rows, score="score", label="label_bin"):
    """Per horizon and distinct score: the rates of all rows scored as high or higher.

    Equal scores are merged before anything is sorted, and the running sums go range by range.
    """
    return _roc_sums(rows, score, label).select(
        "horizon",
        score,
        F.coalesce(F.try_divide(F.col("tp").cast("double"), "positives"), F.lit(0.0)).alias("tpr"),
        F.coalesce(F.try_divide(F.col("fp").cast("double"), "negatives"), F.lit(0.0)).alias("fpr"),
    )


def roc_area(rows, score="score", label="label_bin"):
    """Area under each horizon's curve, by trapezoids; null where a class is missing.

    Twice the area in units of one positive and one negative is whole: each distinct score adds its
    negatives times the positives above it, twice, and those at it, once.
    """
    twice = (F.col("n") * (2 * F.col("tp") - F.col("p"))).cast("decimal(38,0)")
    sums = _roc_sums(rows, score, label).groupBy("horizon").agg(F.sum(twice).alias("twice"), F.max("positives").alias("positives"), F.max("negatives").alias("negatives"))
    whole = 2.0 * F.col("positives") * F.col("negatives")
    return sums.select("horizon", "positives", "negatives", F.try_divide(F.col("twice").cast("double"), whole).alias("area"))
