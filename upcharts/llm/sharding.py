"""Balanced contiguous shards by bytes, with equal texts together; native operators only.

Law ``bytes``: shard sizes are as near equal as whole groups of equal texts allow.
Groups of at least 1/64 of a shard (so at most 64 per shard, whatever the input) are
dealt to the emptiest shards, largest first. The other groups stand in the order of
their first document; global prefix sums of their bytes, from per-block totals, are
cut where the shards' remaining room ends. A shard thus holds a contiguous run of
groups and its large groups.

A document's size is the UTF-8 bytes of its text (null: none) plus 1; null and empty
texts are equal. Within a shard, slots number the rows by (first doc_id of the group,
doc_id). Null doc_ids come first. Rows that are equal in id and text may trade slots.
Other columns are ignored. An empty table gives an empty result.
"""

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upcharts.llm.positions import in_blocks, running_sums
from upcharts.session import materialise

LARGE = 64


def _cuts(room: list[float], rest: int) -> list[float]:
    """Cumulative ends of the shards' shares of ``rest`` bytes, levelling their loads."""
    low, high = 0.0, max(room) + rest
    for _ in range(100):
        level = (low + high) / 2
        filled = sum(max(0.0, level - load) for load in room)
        low, high = (level, high) if filled < rest else (low, level)
    ends, total = [], 0.0
    for load in room:
        total += max(0.0, high - load)
        ends.append(total)
    return ends


def _large_shards(large: list, shards: int) -> tuple[dict[str, int], list[float]]:
    """Shard of each large group, largest first into the emptiest; and the loads."""
    loads, chosen = [0.0] * shards, {}
    free = [(0.0, s) for s in range(shards)]
    for row in sorted(large, key=lambda r: (-r["bytes"], r["digest"])):
        load, shard = heapq.heappop(free)
        chosen[row["digest"]] = shard
        loads[shard] = load + row["bytes"]
        heapq.heappush(free, (loads[shard], shard))
    return chosen, loads


def shard_by_bytes(docs: DataFrame, shards: int = 16) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = materialise(
        docs.select(
            "doc_id",
            (F.octet_length(text) + F.lit(1).cast("long")).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.md5(text.cast("binary")).alias("digest"),
        ),
        "sized",
    )
    groups = materialise(
        sized.groupBy("digest").agg(F.min("doc_id").alias("first"), F.sum("size").alias("bytes"), F.count("*").alias("members")),
        "text_groups",
    )
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    is_large = F.col("bytes") * (LARGE * shards) >= F.lit(total)
    # at most LARGE * shards rows, because their bytes add up to no more than the total
    large = groups.where(is_large).select("digest", "bytes").collect()
    chosen, loads = _large_shards(large, shards)
    ends = _cuts(loads, total - sum(r["bytes"] for r in large))

    small = groups.where(~is_large)
    order = ["first", "digest"]
    placed = running_sums(in_blocks(small, order), order, {"before": F.col("bytes")})
    middle = F.col("before") + F.col("bytes") / 2
    shard = sum((F.when(middle >= F.lit(e), 1).otherwise(0) for e in ends[:-1]), F.lit(0)).cast("int")
    deals = spark.createDataFrame(list(chosen.items()), "digest string, shard int")
    homes = materialise(
        placed.select("digest", "first", "members", shard.alias("shard")).unionByName(
            groups.join(deals, "digest").select("digest", "first", "members", "shard")
        ),
        "group_shards",
    )
    counts = {r["shard"]: r["n"] for r in homes.groupBy("shard").agg(F.sum("members").alias("n")).collect()}
    starts = [sum(counts.get(s, 0) for s in range(k)) for k in range(shards)]

    rows = sized.join(homes.select("digest", "first", "shard"), "digest")
    order = ["shard", "first", "digest", "doc_id"]
    numbered = running_sums(in_blocks(rows, order), order, {"before": F.lit(1)})
    start = F.element_at(F.array(*[F.lit(s).cast("long") for s in starts]), F.col("shard") + 1)
    return numbered.select("doc_id", "size", "text_crc32", "shard", (F.col("before") - start).alias("slot"))


def add_law(sharded: DataFrame) -> DataFrame:
    """The digest columns of the query: the law, and no shard under growth."""
    return sharded.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
