"""Session defaults and the shared folder for data written between jobs."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores="*", shuffle_partitions=8, memory="12g", **conf):
    """A local session with the settings the tests and the bench use."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("naviscope")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # Small shuffles still spread over the cores: parsing pages is CPU work.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark):
    """The folder every executor can reach, from `spark.checkpoint.dir`.

    Unset, a temporary folder serves a local master; on a cluster a machine's
    own folder would be invisible to the others, hence the error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="naviscope-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def run_folder(spark):
    """The folder below the shared one that holds everything this application writes between jobs."""
    return f"{shared_folder(spark).rstrip('/')}/{spark.sparkContext.applicationId}"


def new_folder(spark, name):
    """A path below the run's folder that nobody else uses."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def remove_folder(spark, path):
    """Remove a folder, wherever Spark's file systems put it; no folder is no error."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def folder_exists(spark, path):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def clear_run(spark):
    """Remove what this application wrote between jobs; frames that read it can't be used any more."""
    remove_folder(spark, run_folder(spark))


def materialise(df, name, partition_by=(), path=None):
    """Write `df` once as parquet in the shared folder and read it back.

    Readers start from files, so a lost executor costs its tasks only.
    """
    spark = df.sparkSession
    path = path or new_folder(spark, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
