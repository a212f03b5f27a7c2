"""Incremental load as a stream: each staged file enters the history exactly once.

Micro-batches are appended by the same writer as batch loads, so one table serves
both. A batch is a load with an id of its own: until its one committing write it is
invisible, and once listed it is not loaded again. A batch that breaks off anywhere leaves
the rows of all other loads alone and is simply repeated.
"""

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from upcharts.schemas import CHART_HISTORY
from upcharts.sources.history import append_history, conform

BYTES_PER_BATCH = 64 << 30


def staged_stream(
    spark: SparkSession, folder: str, max_files: int | None = None, max_bytes: int = BYTES_PER_BATCH
) -> DataFrame:
    """Staged NDJSON files as they arrive, in micro-batches of bounded size."""
    reader = spark.readStream.schema(CHART_HISTORY).option("mode", "FAILFAST")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    else:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.json(folder)


def load_stream(staged: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Load all files not yet in the checkpoint, then stop."""
    stream = hashlib.md5(checkpoint.encode()).hexdigest()[:12]

    def load(batch: DataFrame, number: int) -> None:
        load_batch(batch, path, f"s{stream}-{number}")

    return (
        conform(staged)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def load_batch(batch: DataFrame, path: str, load_id: str) -> None:
    """Append ``batch`` to the history once, however often it is called."""
    append_history(batch.withColumn("load_id", F.lit(load_id)), path, allow_new=True, load=load_id)
