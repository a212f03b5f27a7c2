"""The stored history: each load in a folder of its own, and a list of the folders that are live.

A load writes its weeks below ``<path>/load=<id>``, where no reader looks yet, and checks
what it has written. One write then adds a version of the live list (``<path>/_live``),
which makes the load visible and, where it replaces weeks, hides the folders they had. So

* a load that breaks off anywhere is invisible; repeated under its id, it writes its folder
  again, and once listed it is not loaded a second time;
* a reader keeps the folders it began with: nothing is deleted by a replacement.
  ``remove_dead`` frees the space once no reader needs it.

The list has a row per load and week: bookkeeping that the driver reads. Writers take turns.
"""

import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from upcharts.session import list_folder, remove_path
from upcharts.sources.versions import latest_version, read_version, write_version

#: ``folder`` is the week's folder inside the load; empty: the load itself, as applied
LIVE = StructType(
    [StructField("load", StringType()), StructField("folder", StringType()), StructField("rows", LongType()), StructField("live", BooleanType())]
)


@dataclass(frozen=True)
class Written:
    """What a load wrote, counted in the pass that wrote it."""

    load: str
    rows: int
    first_week: object
    last_week: object
    weeks: int


def live_list(spark: SparkSession, path: str) -> list[Row]:
    return read_version(spark, f"{path}/_live", LIVE).collect()


def is_versioned(spark: SparkSession, path: str) -> bool:
    return latest_version(spark, f"{path}/_live") is not None


def is_applied(spark: SparkSession, path: str, load: str) -> bool:
    """Whether the load was made visible once, even if later loads replaced all its weeks."""
    return any(r["load"] == load for r in live_list(spark, path))


def live_folders(spark: SparkSession, path: str) -> list[str]:
    return [f"{path}/load={r['load']}/{r['folder']}" for r in live_list(spark, path) if r["live"]]


def stage(df: DataFrame, path: str, load: str) -> Written:
    """Write the rows of a load to its folder, unseen by readers; what an earlier try left there goes."""
    seen = Observation()
    counted = df.hint("rebalance", "chart_date").observe(
        seen, F.count("*").alias("rows"), F.min("chart_date").alias("first"), F.max("chart_date").alias("last")
    )
    folder = f"{path}/load={load}"
    # rebalance gathers a week into few files, and AQE splits a week that is
    # larger than the advisory partition size instead of giving it to one task
    counted.write.partitionBy("chart_date").mode("overwrite").option("compression", "zstd").parquet(folder)
    found = seen.get
    return Written(load, found["rows"], found["first"], found["last"], len(_weeks(df.sparkSession, folder)))


def _weeks(spark: SparkSession, folder: str) -> list[str]:
    return sorted(name for name in list_folder(spark, folder) if name.startswith("chart_date="))


def _stored_rows(spark: SparkSession, folder: str) -> dict[str, int]:
    """Rows of each week's folder, from the files' footers."""
    weeks = _weeks(spark, folder)
    if not weeks:
        return {}
    named = F.concat(F.lit("chart_date="), F.coalesce(F.col("chart_date").cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")))
    return {r["folder"]: r["count"] for r in spark.read.parquet(folder).groupBy(named.alias("folder")).count().collect()}


def week_folder(week: date | None) -> str:
    return f"chart_date={'__HIVE_DEFAULT_PARTITION__' if week is None else week}"


def live_weeks(spark: SparkSession, path: str) -> list[date]:
    """The weeks the table holds, from the list alone."""
    names = {r["folder"].removeprefix("chart_date=") for r in live_list(spark, path) if r["live"]}
    return sorted(date.fromisoformat(n) for n in names if n[0].isdigit())


def publish(spark: SparkSession, path: str, written: Written, replace: bool, hide: Iterable[date | None] = ()) -> None:
    """Make a staged load visible by one new version of the live list.

    It hides the weeks it brings, if it replaces, and those of ``hide``.
    """
    stored = _stored_rows(spark, f"{path}/load={written.load}")
    if sum(stored.values()) != written.rows:
        raise RuntimeError(f"load {written.load}: {written.rows} rows were written, {sum(stored.values())} are stored")
    hidden = (set(stored) if replace else set()) | {week_folder(w) for w in hide}
    old = [(r["load"], r["folder"], r["rows"], r["live"] and r["folder"] not in hidden) for r in live_list(spark, path)]
    new = [(written.load, "", written.rows, False), *[(written.load, folder, n, True) for folder, n in sorted(stored.items())]]
    write_version(spark.createDataFrame([*old, *new], LIVE), f"{path}/_live")


def write_load(
    df: DataFrame, path: str, load: str | None = None, replace: bool = False, hide: Iterable[date | None] = ()
) -> Written | None:
    """Stage and publish ``df``; nothing happens if ``load`` was applied before."""
    spark = df.sparkSession
    if load is not None and is_applied(spark, path, load):
        return None
    written = stage(df, path, load or f"w{uuid.uuid4().hex[:16]}")
    publish(spark, path, written, replace, hide)
    return written


def read_live(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Rows of the live folders; without a schema, with all columns that any load brought."""
    folders = live_folders(spark, path)
    if not folders:
        return spark.createDataFrame([], schema or "chart_date date")
    reader = spark.read.option("basePath", path)
    reader = reader.schema(schema) if schema is not None else reader.option("mergeSchema", True)
    return reader.parquet(*folders).drop("load")


def load_counts(spark: SparkSession, path: str, load: str) -> DataFrame:
    """chart_date and rows of the weeks a load wrote, as listed when it was published."""
    listed = read_version(spark, f"{path}/_live", LIVE).where((F.col("load") == load) & (F.col("folder") != ""))
    week = F.to_date(F.nullif(F.substring_index("folder", "=", -1), F.lit("__HIVE_DEFAULT_PARTITION__")))
    return listed.select(week.alias("chart_date"), "rows")


def remove_dead(spark: SparkSession, path: str) -> list[str]:
    """Delete the folders no list shows: replaced weeks, and loads that broke off. No load may be under way."""
    rows = live_list(spark, path)
    live = {(f"load={r['load']}", r["folder"]) for r in rows if r["live"]}
    gone = []
    for load in (n for n in list_folder(spark, path) if n.startswith("load=")):
        gone += [f"{path}/{load}/{week}" for week in _weeks(spark, f"{path}/{load}") if (load, week) not in live]
    for folder in gone:
        remove_path(spark, folder)
    return gone


def quarantine_path(path: str, load: str) -> str:
    return f"{path.rstrip('/')}/load={load}"


def write_gated(df: DataFrame, reasons: str, path: str, quarantine: str, load: str, replace: bool = False) -> Written | None:
    """Publish the rows without ``reasons`` (an array column); the others go to the quarantine table.

    The quarantine is written first, to the load's own folder: a load that is repeated replaces it.
    """
    if is_applied(df.sparkSession, path, load):
        return None
    bad = df.where(F.size(reasons) > 0)
    bad.write.mode("overwrite").parquet(quarantine_path(quarantine, load))
    return write_load(df.where(F.size(reasons) == 0).drop(reasons), path, load, replace)


def read_quarantine(spark: SparkSession, quarantine: str) -> DataFrame:
    """Rows kept out, with the load and the reasons."""
    return spark.read.option("mergeSchema", True).parquet(quarantine)

