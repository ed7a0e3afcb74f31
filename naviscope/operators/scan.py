"""Ordered operators that never put a whole key into one task.

A window over a key sorts all rows of that key in one task, which fails when
one key holds a large share of the table. Here each key is cut into chunks of
bounded size that follow the order. A first window works inside each chunk,
one summary row per chunk is scanned per key, and the result of that scan is
joined back on (key, chunk), which is how the chunk window left the rows.

`chunk` is any column that never falls as the order rises: the block of a
file, or a position divided by a fixed width.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

CHUNK_ROWS = 1 << 20


def position_chunk(position, rows=CHUNK_ROWS):
    """Chunks of at most `rows` rows for a position unique within the key."""
    return F.floor(F.col(position) / F.lit(rows)).cast("long")


def add_chunk(df, keys, position, name="chunk", rows=CHUNK_ROWS):
    """`df` with a chunk per row: one in keys of at most `rows` rows, `position_chunk` in larger ones.

    Keys with few rows spread over a wide range of positions so have one summary row, not
    one per position. There are at most count / `rows` larger keys, which bounds the broadcast.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") > rows)
    large = counts.select(*[F.col(k).alias(f"__{k}") for k in keys], F.lit(True).alias("__large"))
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    chunk = F.when(F.col("__large"), position_chunk(position, rows)).otherwise(F.lit(0))
    return df.join(F.broadcast(large), on, "left").select(*df.columns, chunk.cast("long").alias(name))


def place(*names):
    """Key columns as one struct, which is never null even where they are.

    Windows, groups and the join back all use this one column, so the rows stay
    where the first shuffle put them, and null keys match like any others.
    """
    return F.struct(*names).alias("__at")


def with_place(df, *names):
    return df.select("*", place(*names))


def _before(keys, chunk):
    return Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)


def add_row_number(df, keys, chunk, order, name="row_number", total=None):
    """1-based position within the key; with `total`, the key's row count too."""
    df = with_place(df, *keys, chunk)
    counts = df.groupBy("__at").agg(F.count(F.lit(1)).alias("__n")).select("*", "__at.*")
    summary = counts.select(
        "__at",
        F.coalesce(F.sum("__n").over(_before(keys, chunk)), F.lit(0)).alias("__before"),
        F.sum("__n").over(Window.partitionBy(*keys)).alias("__total"),
    )
    inside = Window.partitionBy("__at").orderBy(*order)
    out = df.withColumn("__local", F.row_number().over(inside)).join(summary, "__at")
    out = out.withColumn(name, F.col("__before") + F.col("__local"))
    if total:
        out = out.withColumn(total, F.col("__total"))
    return out.drop("__at", "__local", "__before", "__total")


def add_ntile(df, keys, chunk, order, tiles, name="tile"):
    """Tile 1..`tiles` of each row; the first tiles take the surplus rows."""
    out = add_row_number(df, keys, chunk, order, "__rank", "__count")
    size = F.floor(F.col("__count") / tiles)
    extra = F.col("__count") % tiles
    in_larger = F.col("__rank") <= extra * (size + 1)
    tile = F.when(in_larger, F.ceil(F.col("__rank") / (size + 1))).otherwise(
        extra + F.ceil(F.try_divide(F.col("__rank") - extra * (size + 1), size))
    )
    return out.withColumn(name, tile.cast("int")).drop("__rank", "__count")


def add_running_sum(df, keys, chunk, order, sums):
    """Running sum within the key; `sums` maps new column -> (value, total).

    `total` names a column for the key's whole sum, or is None.
    """
    df = with_place(df, *keys, chunk)
    parts = df.groupBy("__at").agg(*[F.sum(v).alias(f"__{n}") for n, (v, _) in sums.items()])
    before, everything = _before(keys, chunk), Window.partitionBy(*keys)
    summary = parts.select("*", "__at.*").select(
        "__at",
        *[F.coalesce(F.sum(f"__{n}").over(before), F.lit(0)).alias(f"__before_{n}") for n in sums],
        *[F.sum(f"__{n}").over(everything).alias(t) for n, (_, t) in sums.items() if t],
    )
    inside = Window.partitionBy("__at").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = df.select("*", *[F.sum(v).over(inside).alias(f"__in_{n}") for n, (v, _) in sums.items()])
    out = local.join(summary, "__at")
    for n in sums:
        out = out.withColumn(n, F.col(f"__before_{n}") + F.col(f"__in_{n}"))
    return out.drop("__at", *[f"__{p}_{n}" for n in sums for p in ("before", "in")])
