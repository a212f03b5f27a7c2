"""Global running sums over an ordered table, from per-block totals.

The table is range partitioned and stored once with its block number. Running sums
inside a block are a window over that block; what lies before a block comes from
the totals of the blocks, one row each and at most ``MOST_BLOCKS``. No task sees more than
one block.
"""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upcharts.session import materialise

ROWS_PER_BLOCK = 16384
#: beyond so many blocks they grow instead, so that neither the shuffle nor the window over
#: the blocks' totals outgrows a task
MOST_BLOCKS = 100_000


def blocks_for(rows: int, rows_per_block: int = ROWS_PER_BLOCK) -> int:
    return min(MOST_BLOCKS, max(1, math.ceil(rows / rows_per_block)))


def in_blocks(df: DataFrame, order: list[str], rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Store ``df`` range partitioned by ``order``, with its partition in ``block``."""
    n = blocks_for(df.count(), rows_per_block)
    ranged = df.repartitionByRange(n, *order).withColumn("block", F.spark_partition_id())
    return materialise(ranged, "blocks")


def running_sums(
    blocks: DataFrame, order: list[str], sums: dict[str, Column], source: DataFrame | None = None
) -> DataFrame:
    """Add for each entry of ``sums`` its total over all rows that come before.

    ``order`` has to order the rows fully, except rows that are equal. ``source`` may
    name a cheaper frame of the same rows to take the blocks' totals from.
    """
    source = blocks if source is None else source
    totals = source.groupBy("block").agg(*[F.sum(v).alias(f"_{k}") for k, v in sums.items()])
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("block", *[F.coalesce(F.sum(f"_{k}").over(before), F.lit(0)).alias(f"_{k}") for k in sums])
    inside = Window.partitionBy("block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = blocks.withColumns({k: F.coalesce(F.sum(v).over(inside), F.lit(0)) for k, v in sums.items()})
    return local.join(starts, "block").withColumns({k: F.col(k) + F.col(f"_{k}") for k in sums}).drop(*[f"_{k}" for k in sums])
