"""Token files: Parquet lists of ids, written in doc_id order and read selectively.

Texts are range partitioned by doc_id, encoded, and written with one row per document:
doc_id, block (the range), row (its number in the file), n_tokens and the ids as a list
column. The ids use dictionary pages (a vocabulary fits one), the numbers delta pages; row groups and pages have
set sizes and page indexes, so a filter on doc_id reads only pages it needs and a query
on n_tokens alone never touches ids. ``start`` (ids before a document) comes from the
blocks' totals and a running sum over the rows of a block, in the order of the file.

Null texts hold the end id only. Null doc_ids come first. Rows that share a doc_id are
ordered by a hash of their text. Other columns are ignored. An empty table gives an empty
result. Files are Spark's, so a lost task leaves nothing behind.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upcharts.llm.positions import blocks_for, running_sums
from upcharts.llm.ship import in_tasks
from upcharts.llm.text import text_slices
from upcharts.llm.tokens import END, SLICE, VOCABULARY, encoder

ROWS_PER_FILE = 16384
ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 128 << 10
PAGE_ROWS = 256

_ROWS = "doc_id long, row long, n_tokens long, ids array<int>"


def _encoded(vocabulary: str, path: str | None, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, written = encoder(vocabulary, path).encode, 0
        for batch in batches:
            for row, stop, data, offsets in text_slices(batch.column("text"), SLICE):
                ids, bounds = encode(data, offsets, end)
                numbers = np.arange(written, written + stop - row)
                written += stop - row
                yield pa.record_batch(
                    {
                        "doc_id": batch.column("doc_id").slice(row, stop - row),
                        "row": pa.array(numbers),
                        "n_tokens": pa.array(np.diff(bounds)),
                        "ids": pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.view(np.int32))),
                    }
                )

    return run


def write_tokens(docs: DataFrame, folder: str, vocabulary: str = VOCABULARY, vocabulary_path: str | None = None, end: int = END) -> None:
    """Write the ids of all texts to ``folder``, one file for each range of doc_ids."""
    order = ["doc_id", "_tie"]
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("_tie"))
    n = blocks_for(docs.count(), ROWS_PER_FILE)
    ranged = texts.repartitionByRange(n, *order).sortWithinPartitions(*order).select("doc_id", "text")
    rows = in_tasks(ranged, _encoded(vocabulary, vocabulary_path, end), _ROWS).withColumn("block", F.spark_partition_id())
    (
        rows.write.option("compression", "zstd")
        .option("parquet.writer.version", "v2")
        .option("parquet.block.size", ROW_GROUP_BYTES)
        .option("parquet.page.size", PAGE_BYTES)
        .option("parquet.page.row.count.limit", PAGE_ROWS)
        .option("parquet.enable.dictionary", "false")
        .option("parquet.enable.dictionary#ids.list.element", "true")
        .parquet(folder)
    )


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """The files' rows; filters on doc_id and a choice of columns reach the pages."""
    return spark.read.schema(f"{_ROWS}, block int").parquet(folder)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        flat = ids.flatten().to_numpy().astype("<u4")
        ends = np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False))]).tolist()
        crc = [zlib.crc32(flat[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        yield pa.record_batch(
            {
                "doc_id": batch.column("doc_id"),
                "block": batch.column("block"),
                "row": batch.column("row"),
                "n_tokens": pa.array(np.diff(ends), pa.int64()),
                "ids_crc32": pa.array(crc, pa.int64()),
            }
        )


def token_digests(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32."""
    rows = in_tasks(
        read_tokens(spark, folder).select("doc_id", "block", "row", "ids"),
        _sums,
        "doc_id long, block int, row long, n_tokens long, ids_crc32 long",
    )
    # the blocks' totals come from the n_tokens column alone
    placed = running_sums(rows, ["row"], {"start": F.col("n_tokens")}, read_tokens(spark, folder))
    return placed.select("doc_id", "start", "n_tokens", "ids_crc32")
