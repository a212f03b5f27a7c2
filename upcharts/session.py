"""Session settings and the shared folder for intermediate tables."""

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# rows of the input that one task of a sized job takes
ROWS_PER_TASK = 1_000_000
# narrow rows pack so well that the default of 64 MB lets AQE put millions of them into one sort
MERGED_BYTES = "32MB"


def build_session(app_name: str = "upcharts", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the package is tuned for.

    The settings are the same for every master. ``spark.sql.shuffle.partitions``
    belongs to the input, not to the package: give it as the bytes to be shuffled
    over 100 to 200 MB; AQE coalesces what turns out too small. The warehouse raises
    them to its rows while it is built (``sized_for``).
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Parquet unpacks to a multiple of its file size; broadcast choices should know
        "spark.sql.sources.fileCompressionFactor": "3",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
    }
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**settings, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def sized_for(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs that run inside have a task for every ``ROWS_PER_TASK`` of ``rows``, so that sorts fit in memory.

    Counts the session sets are only raised, AQE still merges small partitions, and the
    settings are the session's again afterwards. Results must be computed inside.
    """
    tasks = -(-rows // ROWS_PER_TASK)
    shuffle, first = "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    scan, merged = "spark.sql.files.minPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = {key: spark.conf.get(key, None) for key in (shuffle, first, scan, merged)}
    wanted = {
        shuffle: max(tasks, int(spark.conf.get(shuffle))),
        first: before[first] and max(tasks, int(before[first])),
        scan: max(tasks, int(before[scan] or spark.sparkContext.defaultParallelism)),
        merged: before[merged] or MERGED_BYTES,
    }
    try:
        for key, value in wanted.items():
            if value:
                spark.conf.set(key, str(value))
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    Where that is unset, a folder beside the tables of the warehouse, which a
    cluster shares as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/upcharts/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage at a durable table: a lost executor re-reads files instead of
    recomputing the upstream shuffles. zstd takes a third less room than the default codec.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, in whatever store Spark reaches."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder; none if there is no such folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in system.listStatus(target)] if system.exists(target) else []


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this package wrote."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def table_path(folder: str, table: str) -> str:
    return f"{folder.rstrip('/')}/{table}.parquet"
