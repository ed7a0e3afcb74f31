"""The scheme table: numbers, category benchmarks, scores and labels."""

from pyspark.sql import functions as F

from naviscope.functions import scores, text
from naviscope.operators.scan import place, with_place
from naviscope.schemas import HORIZONS, measure_columns

SCORE_COLUMNS = ("m_risk", "m_rating", "m_alloc", "m_diff", "m_volat")

# Text column -> numeric column; assets of the scheme and risk have own rules.
BASE_NUMBERS = {
    "family_aum": "num_family_aum",
    "crisil_rating": "num_crisil_rating",
    "latest_nav": "num_latest_nav",
    "1yr_return": "num_1yr_return",
    "scheme_min_investment": "num_min_investment",
    "scheme_last_dividend": "num_last_dividend",
    "scheme_bonus": "num_bonus",
}


def add_numbers(df):
    """All numeric columns of the text columns at hand, in one projection.

    Performance columns are parsed under their own names; the text ones are
    replaced.
    """
    performance = [c for c in measure_columns() if c in df.columns]
    rest = [f"`{c}`" for c in df.columns if c not in performance]
    return df.selectExpr(
        *rest,
        f"{text.encode_risk_sql('scheme_risk_text')} AS num_scheme_risk",
        f"coalesce({text.to_numeric_sql('scheme_aum')}, 0D) AS num_scheme_aum",
        *[f"{text.to_numeric_sql(f'`{c}`')} AS {n}" for c, n in BASE_NUMBERS.items()],
        *[f"{text.to_numeric_sql(c)} AS {c}" for c in performance],
    )


def top_families(families, n=10, aum="num_family_aum", name="family_name"):
    """The n families with the largest assets, ties by name."""
    return families.orderBy(F.col(aum).desc_nulls_last(), F.col(name)).limit(n)


def expand_families(families, schemes, key="family_url"):
    """Family columns on each of its schemes.

    `families` must come from `top_families`: its row limit is what makes the
    broadcast safe at any size of the scheme table.
    """
    return schemes.join(F.broadcast(families), key)


def join_details(schemes, details, key="scheme_url"):
    """One detail row per scheme; Spark chooses how to join."""
    return schemes.join(details, key)


def category_benchmarks(wide, category="category", horizons=HORIZONS):
    """Average, best and worst return of each category, seven horizons at once."""
    stats = [
        F.expr(sql)
        for h in horizons
        for sql in (
            f"round(avg(fund_ret_{h}), 9) AS cat_avg_{h}",
            f"max(fund_ret_{h}) AS cat_best_{h}",
            f"min(fund_ret_{h}) AS cat_worst_{h}",
        )
    ]
    return wide.groupBy(category).agg(*stats)


def add_category_benchmarks(wide, stats, category="category", horizons=HORIZONS):
    """Category columns and the difference to them on each scheme.

    `stats` is `category_benchmarks` of the same rows. Read back from storage its
    size is known, so that Spark broadcasts it where it is small and joins by
    sorting, with its treatment of skewed categories, where it is not.
    """
    stats = stats.select(place(category), *[c for c in stats.columns if c != category])
    joined = with_place(wide, category).join(stats, "__at").drop("__at")
    return joined.selectExpr(
        "*", *[f"round(fund_ret_{h} - cat_avg_{h}, 9) AS diff_{h}" for h in horizons]
    )


def add_scores(long):
    """The five scores, with flags where one was undefined and set to 0."""
    alloc = scores.allocation_ratio("num_scheme_aum", "num_family_aum")
    volat = scores.volatility_ratio("cat_worst", "cat_best")
    return long.select(
        "*",
        scores.risk_score("num_scheme_risk").alias("m_risk"),
        scores.rating_score("num_crisil_rating").alias("m_rating"),
        F.coalesce(alloc, F.lit(0.0)).alias("m_alloc"),
        scores.beats_category("diff").alias("m_diff"),
        F.coalesce(volat, F.lit(0.0)).alias("m_volat"),
        alloc.isNull().alias("alloc_undefined"),
        volat.isNull().alias("volat_undefined"),
    )


def add_label(scored):
    """`label` is the rounded mean score, unclamped; `label_bin` is 0 or 1."""
    labelled = scored.withColumn("mean_score", scores.mean_of(*SCORE_COLUMNS))
    labelled = labelled.withColumn("label", scores.half_up(F.col("mean_score")))
    return labelled.withColumn("label_bin", (F.col("label") >= 1).cast("int"))
