"""Train/test split, filters and the ranking reports."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from naviscope.schemas import HORIZONS, TRAIN_RATIO


def add_train_flag(df, positions, key="scheme_idx", ratio=TRAIN_RATIO):
    """`is_train` for keys below `ratio` of the key range of `positions`.

    A threshold on the key needs no global numbering of the rows.
    """
    cut = positions.agg(F.floor(F.lit(ratio) * (F.max(key) + 1))).scalar()
    return df.withColumn("is_train", F.col(key) < cut)


def chosen(df, flag="prediction"):
    """Rows predicted, or labelled, good."""
    return df.filter(F.col(flag) == 1)


def report(top, horizons=HORIZONS):
    """The recommendation columns: name, the seven returns, address."""
    returns = [f"ret_{h}" for h in horizons]
    return top.select("horizon", "rank", "is_train", "scheme_name", *returns, "scheme_url")


def horizon_order(value="fund_ret", tie="scheme_idx"):
    """Best return first, missing last, ties in source order."""
    return [F.col(value).desc_nulls_last(), F.col(tie)]


def rank_horizons(df, value="fund_ret", tie="scheme_idx"):
    """The whole report sorted by horizon and return; a range-partitioned sort."""
    return df.orderBy("horizon", *horizon_order(value, tie))


def top_per_horizon(df, n=5, value="fund_ret", tie="scheme_idx"):
    """The best n per horizon.

    The rank filter sits right on the window, so each task keeps its own best n
    before the shuffle, and a horizon's task receives n rows from each.
    """
    w = Window.partitionBy("horizon").orderBy(*horizon_order(value, tie))
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
