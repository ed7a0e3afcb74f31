"""Small helpers of the text operators."""

import contextlib
import ctypes
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F

from naviscope.session import new_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A side of a join goes to every executor only below so many rows of a few bytes each.
BROADCAST_ROWS = 1_000_000
# Characters that a worker turns into arrays at a time (a longer text makes a chunk of its own).
CHUNK_CHARS = 400_000


def columns(df, **types):
    """Only the named columns, cast; other columns, whatever their names, are left behind."""
    return df.select(*[F.col(name).cast(kind).alias(name) for name, kind in types.items()])


def checked_join(big, keys, on, how, rows=BROADCAST_ROWS):
    """`big` joined to `keys` (stored, narrow), broadcast only if a count finds at most `rows` rows."""
    small = keys.limit(rows + 1).count() <= rows
    return big.join(F.broadcast(keys) if small else keys, on, how)


def without(documents, keys, fingerprint):
    """`documents` but for the rows whose doc_id and fingerprint are in `keys` (stored, distinct).

    `keys` has columns doc_id and fingerprint; `fingerprint` computes the latter from a row.
    """
    keys = keys.select(F.col("doc_id").alias("_id"), F.col("fingerprint").alias("_key"))
    marked = documents.withColumn("_print", fingerprint)
    on = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("_print").eqNullSafe(F.col("_key"))
    return checked_join(marked, keys, on, "left_anti").drop("_print")


def process_cache(name, make):
    """`make()` once per Python worker process; a reused worker keeps it from task to task."""
    import types

    module = sys.modules.setdefault("_naviscope_worker_cache", types.ModuleType("_naviscope_worker_cache"))
    if not hasattr(module, name):
        setattr(module, name, make())
    return getattr(module, name)


def tidy(batches, rows=1000):
    """The rows of Arrow batches in slices; after each batch, unused memory goes back to the system.

    Workers outlive their tasks, so what an allocator keeps would add up over a job's stages.
    """
    trim = getattr(ctypes.CDLL(None), "malloc_trim", lambda _: None)
    for batch in batches:
        for start in range(0, max(1, batch.num_rows), rows):
            yield batch.slice(start, rows)
        del batch
        pa.default_memory_pool().release_unused()
        trim(0)


# Pages and row groups are closed by size after every row; by default a page takes 100 rows at least, which
# the codec holds at once outside the heap.
LARGE_ROWS = {
    "parquet.page.size.row.check.min": "1",
    "parquet.page.size.row.check.max": "1",
    "parquet.block.size.row.check.min": "1",
    "parquet.block.size.row.check.max": "4",
    "parquet.block.size": str(16 << 20),
}


def stored_large_rows(df, name):
    """`materialise` for tables whose rows take a megabyte or so."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.options(**LARGE_ROWS).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def arrow_records(spark, records):
    """Jobs started within hand at most so many rows at a time to Python: for tables of large rows."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(records))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def chunks(batch, key, text, limit=CHUNK_CHARS):
    """(keys, texts) of bounded size from an Arrow batch; a null text is empty."""
    keys, texts, total = [], [], 0
    for k, t in zip(batch.column(key), batch.column(text)):
        t = t.as_py() or ""
        keys.append(k.as_py())
        texts.append(t)
        total += len(t)
        if total >= limit:
            yield keys, texts
            keys, texts, total = [], [], 0
    if keys:
        yield keys, texts
