"""Sectioned text feeds: scan, headings, and the whole way to enriched rows."""

from pyspark.sql import functions as F

from naviscope.functions import text
from naviscope.operators import sections


def _raw(reader, path):
    return reader.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").alias("line"),
    )


def add_position(lines):
    """`pos`, rising with the lines of a split in the order they were read."""
    return lines.withColumn("pos", F.monotonically_increasing_id())


def read_lines(spark, path):
    """Feed lines as (file, block, line, pos).

    Files stay splittable: `block` is the byte offset of the split a line was
    read from and `pos` rises within it, so (block, pos) is the order of the
    file, and a block never holds more than one split's worth of lines.
    """
    return add_position(_raw(spark.read, path))


def stream_lines(spark, path, **options):
    """(file, block, line) of new files as a stream; `add_position` per batch."""
    return _raw(spark.readStream.options(**options), path)


def headings_of(lines, delimiter=";"):
    """(file, headings): the first non-blank line of each file, split and trimmed."""
    kept = lines.filter(~text.is_blank("line"))
    first = kept.groupBy("file").agg(F.min_by("line", F.struct("block", "pos")).alias("line"))
    return first.select("file", text.split_fields("line", delimiter).alias("headings"))


def heading_names(lines):
    """Every heading name of any file, by its first place; one row per column reaches the driver."""
    names = headings_of(lines).select(F.posexplode("headings").alias("at", "name"))
    first = names.groupBy("name").agg(F.min("at").alias("at")).orderBy("at", "name")
    return [r.name for r in first.collect()]


def enriched_feed(lines, dimension, names=None, strict=False):
    """(enriched rows, rejects) of feed lines; `names` spares the header job."""
    return enriched(sections.with_context(lines), dimension, names or heading_names(lines), strict)


def enriched(sectioned, dimension, names, strict=False):
    """`enriched_feed` of lines that have their context."""
    rows, rejects = sections.split_rows(sectioned)
    return sections.enrich(rows, names, dimension, strict=strict), rejects
