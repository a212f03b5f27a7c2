"""Connected components by alternating star contraction.

Each round is two aggregations and two joins over the edges; the edges of a round are
stored, so a lost executor never repeats earlier rounds. Hot nodes are aggregated
before the shuffle, and AQE may split the joins on them.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upcharts.session import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of each node to the least node around it."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    larger = both.where("v > u").join(least, "u")
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link the smaller neighbours of each node, and itself, to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for each node with a link; the component is its least node.

    ``links`` has long columns u and v. Links of a node to itself are ignored.
    """
    edges = materialise(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct(), "links")
    state = _state(edges)
    while state[0]:
        edges = materialise(_small_star(_large_star(edges)), "stars")
        before, state = state, _state(edges)
        if state == before:
            break
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(edges.select(F.col("v"), F.col("v"))).distinct()
