"""Joins of two sources on keys and names."""

import uuid

from pyspark.sql import functions as F

from naviscope.session import new_folder


def lookup(df, dimension, key, dimension_key, strict=False):
    """Dimension columns on each row; one dimension row per key is required.

    Without `strict` unknown keys give nulls, with it an error at run time.
    Spark broadcasts the dimension when its size allows.
    """
    out = df.join(dimension, df[key] == dimension[dimension_key], "left")
    if not strict:
        return out
    missing = F.raise_error(F.concat_ws(" ", F.lit("unknown key:"), F.col(key).cast("string")))
    checked = F.when(dimension[dimension_key].isNull(), missing).otherwise(df[key])
    return out.withColumn(key, checked)


def unmatched(df, dimension, key, dimension_key):
    return df.join(dimension, df[key] == dimension[dimension_key], "left_anti")


def name_matches(left, right, left_keys, right_keys, right_id):
    """Each left row with its counterpart on normalised key columns.

    Several right rows may share a key: then the id is null, `n_candidates` says
    how many there are, and `ambiguous_names` lists them. They are counted before
    the join, so a common name cannot multiply the result.
    """
    keys = [f"__k{i}" for i in range(len(left_keys))]
    only = F.when(F.count(F.lit(1)) == 1, F.min(right_id))
    candidates = (
        right.select(right_id, *[k.alias(n) for k, n in zip(right_keys, keys)])
        .groupBy(*keys)
        .agg(only.alias(right_id), F.count(F.lit(1)).alias("n_candidates"))
    )
    keyed = left.select("*", *[k.alias(n) for k, n in zip(left_keys, keys)])
    return keyed.join(candidates, keys, "left").drop(*keys)


def ambiguous_names(right, right_keys, right_id):
    """(keys, id) of every row whose key columns (name -> expression) others share."""
    rows = right.select(*[k.alias(n) for n, k in right_keys.items()], right_id)
    names = list(right_keys)
    shared = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").drop("__n")
    return rows.join(shared, names)


def stored_by_key(df, key, name, buckets=None):
    """`df` written once as a table bucketed and sorted by `key`: joins and groups on it need no exchange.

    Each bucket is one file. The table is external, in the shared folder; sources that are joined
    take the same number of buckets, by default the session's shuffle partitions.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    full_name = f"{name}_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", new_folder(spark, name))
    writer.saveAsTable(full_name)
    return spark.table(full_name)


def details_by_key(listed, details, key, order, buckets=None):
    """(rows, exceptions) of two sources that are matched on `key`, both stored bucketed by it.

    `rows`: each listed row with its details; of repeated details the last in the order of the
    columns `order` counts. `exceptions`: key, kind and n_rows of keys that are listed without details
    (missing), have details without being listed (extra), or are repeated in either source
    (listed twice, repeated). A null key matches nothing: it is missing or extra.
    """
    listed = stored_by_key(listed, key, "listed", buckets)
    details = stored_by_key(details, key, "details", buckets)
    others = [c for c in details.columns if c not in (key, *order)]
    last = details.groupBy(key).agg(F.max(F.struct(*order, *others)).alias("__last"), F.count(F.lit(1)).alias("__n_details"))
    counted = listed.groupBy(key).agg(F.count(F.lit(1)).alias("__n_listed"))
    # The tables are large by nature; a merge join keeps to their buckets.
    rows = listed.join(last.hint("merge"), key).select(*listed.columns, *[F.col(f"__last.{c}").alias(c) for c in (*order, *others)])
    both = counted.join(last.drop("__last").hint("merge"), key, "full")
    kinds = {
        "missing": (F.col("__n_details").isNull(), "__n_listed"),
        "extra": (F.col("__n_listed").isNull(), "__n_details"),
        "listed twice": (F.col("__n_listed") > 1, "__n_listed"),
        "repeated": (F.col("__n_details") > 1, "__n_details"),
    }
    found = F.filter(F.array(*[F.when(on, F.struct(F.lit(k).alias("kind"), F.col(n).alias("n_rows"))) for k, (on, n) in kinds.items()]), lambda x: x.isNotNull())
    exceptions = both.select(key, F.explode(found).alias("x")).select(key, "x.kind", "x.n_rows")
    return rows, exceptions
