"""Sectioned feeds as a data source of Spark: `spark.read.format("sectioned_feed")`, and `readStream`.

A file is cut into ranges of `rangeBytes`; a line belongs to the range that holds its first byte, so
that one huge file is read by many tasks. Columns: file, block (the range's first byte), pos (rising
with the lines of a range), line. Batch and stream read the same ranges. Paths are those that Arrow's file
systems know (local, HDFS and object stores); `feed.read_lines` reads any that Spark does.
"""

import io
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "file string, block long, pos long, line string"
RANGE_BYTES = 64 << 20
BATCH_LINES = 10_000
READ_BYTES = 1 << 20


class Range(InputPartition):
    def __init__(self, file, start, end):
        self.file, self.start, self.end = file, start, end


def _files(path):
    """(file system, [(modified, path, size)]) of a file or of all files below a folder, hidden ones left out."""
    from pyarrow import fs

    system, place = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    info = system.get_file_info(place)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(place, recursive=True))
    shown = [f for f in found if f.type == fs.FileType.File and not any(p[:1] in "._" for p in f.path[len(place) :].strip("/").split("/") if p)]
    return system, sorted((f.mtime_ns or 0, f.path, f.size) for f in shown)


def _ranges(files, range_bytes):
    return [Range(path, start, min(start + range_bytes, size)) for _, path, size in files for start in range(0, size, range_bytes)]


def _read(path, part):
    """Record batches of the lines that begin in a range."""
    from pyarrow import fs

    system = fs.FileSystem.from_uri(path)[0] if "://" in path or path.startswith("file:") else fs.LocalFileSystem()
    # The byte before the range says whether its first byte begins a line.
    at = max(part.start - 1, 0)
    pos, lines, block = 0, [], part.start

    def batch():
        n = len(lines)
        columns = [pa.array([part.file] * n), pa.array([block] * n, pa.int64()), pa.array(range(pos - n, pos), pa.int64()), pa.array(lines, pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["file", "block", "pos", "line"])

    with io.BufferedReader(system.open_input_file(part.file), READ_BYTES) as f:
        f.seek(at)
        if part.start:
            at += len(f.readline())
        while at < part.end:
            data = f.readline()
            at += len(data)
            lines.append(data.removesuffix(b"\n").decode("utf-8", "replace"))
            pos += 1
            if len(lines) >= BATCH_LINES:
                yield batch()
                lines.clear()
    if lines:
        yield batch()


class _Options:
    def __init__(self, options):
        if "path" not in options:
            raise ValueError("a path is needed")
        self.path = options["path"]
        self.range_bytes = int(options.get("rangeBytes", RANGE_BYTES))
        if self.range_bytes < 1:
            raise ValueError("rangeBytes must be positive")


class FeedReader(DataSourceReader, _Options):
    def __init__(self, options):
        _Options.__init__(self, options)

    def partitions(self):
        return _ranges(_files(self.path)[1], self.range_bytes)

    def read(self, partition):
        return _read(self.path, partition)


class FeedStreamReader(DataSourceStreamReader, _Options):
    """New files by modification time and name; an offset is the last file taken in."""

    def __init__(self, options):
        _Options.__init__(self, options)

    def initialOffset(self):
        return {"modified": -1, "file": ""}

    def latestOffset(self):
        files = _files(self.path)[1]
        return {"modified": files[-1][0], "file": files[-1][1]} if files else self.initialOffset()

    def partitions(self, start, end):
        after, upto = ((o["modified"], o["file"]) for o in (start, end))
        return _ranges([f for f in _files(self.path)[1] if after < f[:2] <= upto], self.range_bytes)

    def read(self, partition):
        return _read(self.path, partition)

    def commit(self, end):
        pass


class SectionedFeed(DataSource):
    @classmethod
    def name(cls):
        return "sectioned_feed"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return FeedReader(self.options)

    def streamReader(self, schema):
        return FeedStreamReader(self.options)


def register(spark):
    spark.dataSource.register(SectionedFeed)


def read_feed(spark, path, **options):
    """Lines (file, block, pos, line) of feed files, like `feed.read_lines`."""
    register(spark)
    return spark.read.format("sectioned_feed").options(**options).load(path)


def stream_feed(spark, path, **options):
    register(spark)
    return spark.readStream.format("sectioned_feed").options(**options).load(path)
