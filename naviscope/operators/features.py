"""Model features f0..f9, their imputation, coverage and class balance."""

from pyspark.sql import functions as F

from naviscope.schemas import FEATURE_NAMES

FEATURES = tuple(f"f{i}" for i in range(len(FEATURE_NAMES)))

# The eight features that do not depend on the horizon, in order.
BASE_FEATURES = (
    "num_scheme_risk",
    "num_crisil_rating",
    "num_family_aum",
    "num_scheme_aum",
    "num_latest_nav",
    "num_min_investment",
    "num_last_dividend",
    "num_bonus",
)

MODES = ("per_horizon", "reference")

# Copies of one row that a task makes at a time.
COPIES = 10_000


def _return_feature(mode, own, first):
    """A return feature: the horizon's own value, or the first horizon's gated by it.

    In `reference` mode every later horizon shows the first horizon's value
    where its own is present and not zero; if that value is missing the feature
    is missing too, and imputation fills it.
    """
    if mode == "per_horizon":
        return f"coalesce({own}, 0D)"
    return (
        f"CASE WHEN horizon = '1m' THEN coalesce({own}, 0D) "
        f"WHEN coalesce({own}, 0D) <> 0 THEN {first} ELSE 0D END"
    )


def feature_rows(labelled, mode="per_horizon", keep=()):
    """(scheme_idx, horizon, is_train, f0..f9, label, label_bin), plus `keep`."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    base = [f"coalesce(double({c}), 0D) AS f{i}" for i, c in enumerate(BASE_FEATURES)]
    return labelled.selectExpr(
        "scheme_idx",
        "horizon",
        "is_train",
        *base,
        f"{_return_feature(mode, 'fund_ret', 'ret_1m')} AS f8",
        f"{_return_feature(mode, 'cat_avg', 'cat_avg_first')} AS f9",
        "label",
        "label_bin",
        *keep,
    )


def feature_means(rows, train_only=False):
    """Mean of every feature per horizon: one pass, one row per horizon."""
    rows = rows.filter("is_train") if train_only else rows
    return rows.groupBy("horizon").agg(*[F.avg(f).alias(f) for f in FEATURES])


def impute_means(rows, train_only=False):
    """Missing features replaced by their horizon's mean, 0 where there is none."""
    means = feature_means(rows, train_only)
    means = means.selectExpr("horizon", *[f"{f} AS mean_{f}" for f in FEATURES])
    rest = [c for c in rows.columns if c not in FEATURES]
    filled = [f"coalesce({f}, mean_{f}, 0D) AS {f}" for f in FEATURES]
    # One row per horizon, and the horizons are a fixed list: safe to broadcast.
    return rows.join(F.broadcast(means), "horizon").selectExpr(*rest, *filled)


def feature_coverage(rows):
    """Share of rows per horizon in which a feature is not zero."""
    shares = rows.groupBy("horizon").agg(
        *[F.expr(f"avg(CASE WHEN {f} <> 0 THEN 1D ELSE 0D END)").alias(f) for f in FEATURES]
    )
    return name_features(shares, "coverage")


def name_features(wide, value):
    """One row per horizon and feature from columns f0..f9."""
    pairs = ", ".join(f"'{n}', {f}" for f, n in zip(FEATURES, FEATURE_NAMES))
    return wide.selectExpr("horizon", f"stack({len(FEATURES)}, {pairs}) AS (feature, {value})")


def balance(rows, label="label_bin"):
    """Good and total per horizon."""
    return rows.groupBy("horizon").agg(
        F.sum(label).cast("long").alias("good"), F.count(F.lit(1)).alias("total")
    )


def duplicate_minority(rows, label="label_bin"):
    """Good rows repeated until they are about as many as the bad ones.

    The factor is the rounded ratio of bad to good per horizon, at least 1. Copies
    are made in runs of COPIES that are dealt out first: no task makes all of a row's.
    """
    b = balance(rows, label)
    factor = F.greatest(
        F.floor(F.try_divide(F.col("total") - F.col("good"), F.col("good")) + 0.5), F.lit(1)
    )
    factors = b.select("horizon", F.coalesce(factor, F.lit(1)).cast("int").alias("__times"))
    times = F.when(F.col(label) == 1, F.col("__times")).otherwise(1)
    runs = (
        rows.join(F.broadcast(factors), "horizon")  # one row per horizon
        .withColumn("__times", times)
        .withColumn("__first", F.explode(F.sequence(F.lit(1), F.col("__times"), F.lit(COPIES))))
        .repartition(*rows.columns, "__first")
    )
    last = F.least(F.col("__times"), F.col("__first") + (COPIES - 1))
    return runs.withColumn("copy", F.explode(F.sequence(F.col("__first"), last))).drop("__times", "__first")


def thin_majority(rows, share, key="scheme_idx", label="label_bin"):
    """All good rows and about `share` of the bad ones, chosen by a hash of the key."""
    limit = format(int(share * 16**8), "08x")
    slot = F.expr(f"substr(md5(concat_ws('|', {key}, horizon)), 1, 8)")
    return rows.filter((F.col(label) == 1) | (slot < limit))
