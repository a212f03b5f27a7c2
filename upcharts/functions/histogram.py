"""Exact statistics of integer measures from a (key, value, count) histogram.

One partially aggregated shuffle brings the rows down to a histogram; every
statistic is then exact integer arithmetic over it. No task ever holds the raw
values of a key, however hot the key is.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# values per block at the levels of the median search
_WIDTHS = (1 << 21, 1 << 10)


def value_histogram(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows per (keys, value): columns ``*keys, value, freq``; NULL values are left out."""
    known = df.where(F.col(value).isNotNull())
    return known.groupBy(*keys, F.col(value).cast("long").alias("value")).agg(F.count("*").alias("freq"))


def _blocks_with_middle(hist: DataFrame, keys: Sequence[str], width: int, outer: DataFrame | None, outer_width: int) -> DataFrame:
    """Blocks of ``width`` values that hold a middle position: ``*keys, block, before, lower, upper``.

    ``outer`` are the wider blocks found before; only values inside them are looked at.
    """
    blocked = hist.withColumn("block", _block(width))
    inside = list(keys)
    if outer is not None:
        found = outer.withColumnRenamed("block", "outer").withColumnRenamed("before", "ahead")
        blocked = blocked.withColumn("outer", _block(outer_width)).join(found, [*keys, "outer"])
        inside += ["outer", "ahead", "lower", "upper"]
    blocks = blocked.groupBy(*inside, "block").agg(F.sum("freq").alias("in_block"))
    by_block = Window.partitionBy(*inside).orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    blocks = blocks.withColumn("upto", F.sum("in_block").over(by_block))
    if outer is None:
        total = F.sum("in_block").over(Window.partitionBy(*keys))
        blocks = blocks.withColumns({"total": total, "ahead": F.lit(0).cast("long")})
        blocks = blocks.withColumns({"lower": F.expr("(total + 1) div 2"), "upper": F.expr("(total + 2) div 2")})
    before, upto = F.col("ahead") + F.col("upto") - F.col("in_block"), F.col("ahead") + F.col("upto")
    holds = [(before < F.col(at)) & (F.col(at) <= upto) for at in ("lower", "upper")]
    return blocks.where(holds[0] | holds[1]).select(*keys, "block", before.alias("before"), "lower", "upper")


def _block(width: int) -> Column:
    # never NULL: the join adds no filter on it, so both sides share one histogram
    return F.coalesce(F.floor(F.col("value") / width), F.lit(0))


def histogram_median(hist: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Exact median per key: ``*keys, median``.

    Finds the wide blocks of values that hold the middle positions, then narrow blocks inside
    them, then the value. For values of 32 bits no running sum covers more than 2,048
    rows, whatever the number of distinct values.
    """
    outer, outer_width = None, 0
    for width in _WIDTHS:
        outer, outer_width = _blocks_with_middle(hist, keys, width, outer, outer_width), width
    in_block = Window.partitionBy(*keys, "block").orderBy("value")
    seen = F.col("before") + F.sum("freq").over(in_block.rowsBetween(Window.unboundedPreceding, 0))

    def middle(position: str) -> Column:
        holds = (F.col("seen") - F.col("freq") < F.col(position)) & (F.col(position) <= F.col("seen"))
        return F.max(F.when(holds, F.col("value")))

    return (
        hist.withColumn("block", _block(outer_width))
        .join(outer, [*keys, "block"])
        .withColumn("seen", seen)
        .groupBy(*keys)
        .agg(((middle("lower") + middle("upper")) / 2).alias("median"))
    )


def histogram_summary(hist: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``*keys, n, total, top, mean, se, mean_without_top`` per key.

    The variance comes from exact integer sums, so it does not depend on the
    order in which partitions are merged. Sums are 38 digits wide; squares are taken
    around the whole part of the mean, so no product of two sums is needed. ``se``
    needs two rows.
    """
    wide = "decimal(38,0)"
    value, freq = F.col("value").cast("decimal(19,0)"), F.col("freq").cast("decimal(19,0)")
    weighted = (value * freq).cast(wide)
    n, total = F.col("n").cast("double"), F.col("total")
    # q = total div n, r = total - q n: the squares around the mean are
    # sum (x - q)^2 - r^2 / n
    q = F.expr("total div n").cast("decimal(19,0)")
    r = (total - (q * F.col("n").cast("decimal(19,0)")).cast(wide)).cast("double")
    around_q = F.col("squares") - (2 * q * total).cast(wide) + (q * q * F.col("n").cast("decimal(19,0)")).cast(wide)
    spread = F.greatest(around_q.cast("double") - r * (r / n), F.lit(0.0))
    return (
        hist.groupBy(*keys)
        .agg(
            F.sum("freq").alias("n"),
            F.sum(weighted).cast(wide).alias("total"),
            F.sum((weighted * value).cast(wide)).cast(wide).alias("squares"),
            F.max("value").alias("top"),
        )
        .select(
            *keys,
            "n",
            "total",
            "top",
            (total.cast("double") / n).alias("mean"),
            F.when(F.col("n") > 1, F.sqrt(spread / (n * (n - 1)))).alias("se"),
            F.when(F.col("n") > 1, (total - F.col("top")).cast("double") / (n - 1)).alias("mean_without_top"),
        )
    )
