"""Exact deduplication against a persistent digest index.

The index is a table bucketed and sorted by digest, with a row for each batch that held a
text: the batch that brought it (``first``) names the row that stays, all of them count
copies. Documents come in batches of descending doc_id. A batch is grouped by digest,
freed of digests the index holds by a sort-merge anti-join (the index side is not
shuffled) and appended; what the index holds already adds its number of copies.

Digests that hold more than a thousandth of the rows are at most a thousand, so they meet
the documents by broadcast and no task gathers a hot one. Deduplication shuffles SHA-256
digests only. ``drop_copies`` takes out the rows that go: where their keys are small
enough to broadcast, texts stay where they are; beyond that Spark shuffles the rows.

Texts are equal when identical after lower-casing A-Z. A null text counts as empty.
Of equal new texts the row with the largest doc_id stays (a null doc_id is smaller
than any other); a text that an earlier call has brought keeps the row of that call. Rows
that repeat doc_id and text are one document and share its decision. Other columns are
ignored, whatever their names. An empty table gives an empty result and leaves the
index as it is.
"""

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from upcharts.llm.prefilter import marked
from upcharts.session import materialise

ROWS_PER_BUCKET = 1 << 20
#: digests with more than this share of the rows are broadcast
HOT_SHARE = 1000
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def normalised(text: str | Column) -> Column:
    """Lower-case A-Z and nothing else; null becomes empty."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def digest_of(text: str | Column = "text") -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


def buckets_for(rows: int) -> int:
    """Buckets of an index that is to hold about ``rows`` texts; fixed once it exists."""
    return max(8, -(-rows // ROWS_PER_BUCKET))


def open_index(spark: SparkSession, path: str, buckets: int = 8) -> str:
    """Name of the index table stored at ``path``, which is created if missing.

    ``buckets`` must be the same each time the same path is opened.
    """
    name = "digest_index_" + hashlib.md5(path.encode()).hexdigest()
    spark.sql(
        f"""CREATE TABLE IF NOT EXISTS {name} (digest BINARY, keep_id BIGINT, copies BIGINT, first BOOLEAN)
        USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {int(buckets)} BUCKETS LOCATION '{path}'"""
    )
    return name


def append_batch(digests: DataFrame, index: str, buckets: int) -> None:
    """Append a batch: digests the index lacks with the row that stays, the others with their copies."""
    spark = digests.sparkSession
    groups = digests.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("copies"))
    groups = materialise(groups, "batch_digests")
    known = spark.table(index).where("first").select("digest").hint("merge")
    fresh = groups.join(known, "digest", "left_anti").withColumn("first", F.lit(True))
    again = groups.join(known, "digest", "left_semi").select("digest", F.lit(None).cast("long"), "copies", F.lit(False))
    # the result is stored first: a table cannot be appended to while it is read
    rows = materialise(fresh.union(again), "fresh_digests")
    rows.repartition(buckets, "digest").write.insertInto(index)


def _batches(digests: DataFrame, batches: int) -> list[Column]:
    """Conditions that cut the documents by doc_id, largest first; null doc_ids come last."""
    shares = [k / batches for k in range(1, batches)]
    cuts = sorted({int(c) for c in (digests.approxQuantile("doc_id", shares, 0.01) if shares else [])}, reverse=True)
    above = [None, *cuts]
    conditions = [(F.col("doc_id") >= low) & (F.lit(True) if high is None else F.col("doc_id") < high) for high, low in zip(above, cuts, strict=False)]
    rest = F.col("doc_id").isNull() | (F.col("doc_id") < cuts[-1]) if cuts else F.lit(True)
    return [*conditions, rest]


def dedup_against(docs: DataFrame, path: str, buckets: int | None = None, batches: int = 2) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    ``group_size`` counts all copies the index has seen.
    """
    spark = docs.sparkSession
    digests = materialise(docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest_of().alias("digest")), "digests")
    total = digests.count()
    buckets = buckets or buckets_for(total)
    index = open_index(spark, path, buckets)
    for condition in _batches(digests, batches):
        append_batch(digests.where(condition), index, buckets)
    # buckets hold whole digests, so this needs no shuffle
    known = spark.table(index).groupBy("digest").agg(F.max("keep_id").alias("keep_id"), F.sum("copies").alias("group_size"))
    seen = spark.table(index).agg(F.sum("copies")).first()[0] or 0
    # fewer than ``HOT_SHARE`` digests can hold more than that share of all rows
    hot = materialise(known.where(F.col("group_size") > seen // HOT_SHARE), "hot_digests")
    by_copy = digests.join(F.broadcast(hot), "digest")
    others = digests.join(F.broadcast(hot.select("digest")), "digest", "left_anti").join(known.hint("merge"), "digest")
    return by_copy.unionByName(others).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, path: str, buckets: int | None = None, batches: int = 2) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    decided = dedup_against(docs, path, buckets, batches)
    gone = materialise(decided.where("NOT kept").select("doc_id", F.unhex("text_sha256").alias("digest")).distinct(), "dropped_copies")
    # the rows stand in a struct of their own, so that none of their columns can clash
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("of"))
    rows = marked(rows, gone.select(F.col("doc_id").alias("of")), ["of"])
    maybe = rows.where("_maybe").select("row", "of", digest_of("row.text").alias("held"))
    same = F.col("of").eqNullSafe(F.col("doc_id")) & (F.col("held") == F.col("digest"))
    return rows.where("NOT _maybe").select("row.*").union(maybe.join(gone, same, "left_anti").select("row.*"))
