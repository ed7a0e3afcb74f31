"""Wide and long forms of the performance measures."""

from pyspark.sql import functions as F

from naviscope.schemas import HORIZONS, MEASURES, measure_columns


def performance_wide(long, keys, horizons=HORIZONS, value="value", order=None):
    """(keys, measure, horizon, value) to one column per measure and horizon.

    The columns are fixed, so no job has to look for them. Of a repeated cell
    the last in `order` wins, or the largest value where no order is given.
    """
    cell = F.concat_ws("_", "measure", "horizon")

    def pick(name):
        mine = F.when(cell == name, F.col(value))
        return F.max_by(mine, F.when(cell == name, F.col(order))) if order else F.max(mine)

    return long.groupBy(*keys).agg(*[pick(c).alias(c) for c in measure_columns(horizons)])


def performance_cells(wide, keys, horizons=HORIZONS, value="value"):
    """The inverse: (keys, measure, horizon, value); unknown cells are null, so no key is lost."""
    cells = ", ".join(
        f"struct('{m}' AS measure, '{h}' AS horizon, {m}_{h} AS {value})"
        for m in MEASURES.values()
        for h in horizons
    )
    return wide.selectExpr(*keys, f"inline(array({cells}))")


def by_horizon(wide, horizons=HORIZONS, first="1m"):
    """One row per scheme and horizon with its five measures.

    All returns stay on every row as `ret_1m` .. `ret_5y`, the first horizon's
    category average as `cat_avg_first`. The rows are made in place: no shuffle,
    and Catalyst drops the columns nobody reads.
    """
    wide_columns = set(measure_columns(horizons))
    rest = [f"`{c}`" for c in wide.columns if c not in wide_columns]
    measures = MEASURES.values()
    rows = ", ".join(
        f"struct('{h}' AS horizon, " + ", ".join(f"{m}_{h} AS {m}" for m in measures) + ")"
        for h in horizons
    )
    return wide.selectExpr(
        *rest,
        *[f"fund_ret_{h} AS ret_{h}" for h in horizons],
        f"cat_avg_{first} AS cat_avg_first",
        f"inline(array({rows}))",
    )
