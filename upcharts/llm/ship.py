"""Arrow functions on executors, with this package sent along."""

import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import upcharts

# a task and its Python worker hold a batch several times over, so that it is kept far
# below Spark's own bound of 64 MB; a single larger row is a batch of its own
BATCH_BYTES = 4 << 20

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package through Spark, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(upcharts.__file__).parent
    path = os.path.join(tempfile.mkdtemp(prefix="upcharts-"), "upcharts.zip")
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def in_tasks(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow`` with a function of this package, over batches of bounded size.

    The bound is a setting of the session and stays in force.
    """
    ship_package(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df.mapInArrow(function, schema)
