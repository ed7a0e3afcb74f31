"""Daily feed files taken in as they arrive."""

from pyspark.sql import functions as F

from naviscope.operators import sections
from naviscope.session import folder_exists, materialise, new_folder, remove_folder
from naviscope.sources import feed


def _run(spark, source, checkpoint, write, files_per_batch):
    """Start a query that hands each batch of lines, with its context, to `write(sectioned, batch_id)`.

    The batch is stored, since good and rejected rows both start from it and the files are read once;
    once `write` is done the store is removed.
    """
    options = {"maxFilesPerTrigger": files_per_batch} if files_per_batch else {}

    def batch(lines, batch_id):
        path = new_folder(spark, "sectioned")
        try:
            write(materialise(sections.with_context(feed.add_position(lines)), "sectioned", path=path), batch_id)
        finally:
            remove_folder(spark, path)

    lines = feed.stream_lines(spark, source, **options)
    return lines.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _plain(rows):
    """Columns named without blanks and capitals."""
    return rows.select(*[F.col(f"`{c}`").alias(c.replace(" ", "_").lower()) for c in rows.columns])


def start_ingest(spark, source, target, checkpoint, dimension, names, files_per_batch=None):
    """Enrich each new feed file once and append it to `target` as parquet.

    A file is read in one batch and its sections never leave it, so no state is
    kept between batches. A batch that is run again replaces its own folder.
    Rows whose field count is wrong go to `target`/rejects in the same way.
    """

    def write(sectioned, batch_id):
        good, rejects = feed.enriched(sectioned, dimension, names)
        _plain(good).write.mode("overwrite").parquet(f"{target}/rows/batch={batch_id}")
        rejects.select("file", "line_no", "line").write.mode("overwrite").parquet(
            f"{target}/rejects/batch={batch_id}"
        )

    return _run(spark, source, checkpoint, write, files_per_batch)


def ingest(*args, **options):
    """`start_ingest`, until every file present has been taken in."""
    query = start_ingest(*args, **options)
    query.awaitTermination()
    return query


def start_upsert(spark, source, target, checkpoint, dimension, names, day="day", code="code", files_per_batch=None):
    """Keep in `target` one row per day and code: the one of the last batch, file and line that had it.

    `day` and `code` are plain column names. Only the days that a batch holds are read and written,
    a partition each, by dynamic overwrite; rows of these days that the batch doesn't have stay. A
    batch that is run again changes nothing. Rows without a day or a code, and rows whose field count
    is wrong, go to `target`/rejects by batch.
    """

    def write(sectioned, batch_id):
        good, rejects = feed.enriched(sectioned, dimension, names)
        rows = _plain(good)
        keyless = (F.coalesce(F.trim(day), F.lit("")) == "") | (F.coalesce(F.trim(code), F.lit("")) == "")
        without = rows.where(keyless).select("file", "line_no").join(sectioned.select("file", "line_no", "line"), ["file", "line_no"])
        rejects = rejects.select("file", "line_no", "line").unionByName(without.select("file", "line_no", "line"))
        rejects.write.mode("overwrite").parquet(f"{target}/rejects/batch={batch_id}")
        new = rows.where(~keyless).withColumn("version", F.struct(F.lit(batch_id).cast("long").alias("batch"), "file", F.col("line_no").cast("long").alias("line"))).drop("file", "line_no")
        path = f"{target}/rows"
        known = new
        if folder_exists(spark, path):
            # The days of the batch, read from the partitions of these days alone.
            days = F.broadcast(new.select(day).distinct())
            known = new.unionByName(spark.read.schema(new.schema).parquet(path).join(days, day, "left_semi"))
        others = [c for c in new.columns if c not in (day, code, "version")]
        last = known.groupBy(day, code).agg(F.max_by(F.struct("version", *others), "version").alias("last"))
        # Stored first: a job can't replace the files it reads.
        staged = new_folder(spark, "upsert")
        try:
            merged = materialise(last.select(day, code, "last.*"), "upsert", path=staged)
            merged.repartition(day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)
        finally:
            remove_folder(spark, staged)

    return _run(spark, source, checkpoint, write, files_per_batch)


def read_snapshots(spark, target, day="day"):
    """The rows that `upsert` keeps, the day as the text it was, whatever it looks like."""
    path = f"{target}/rows"
    schema = spark.read.parquet(path).schema
    kinds = ", ".join(f"`{f.name}` {'string' if f.name == day else f.dataType.simpleString()}" for f in schema)
    return spark.read.schema(kinds).parquet(path)


def upsert(*args, **options):
    """`start_upsert`, until every file present has been taken in."""
    query = start_upsert(*args, **options)
    query.awaitTermination()
    return query
