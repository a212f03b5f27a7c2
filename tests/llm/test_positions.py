"""Places in files and blocks."""

from pyspark.sql import functions as F

from upcharts.llm import positions, token_files
from upcharts.session import fresh_path


def test_start_points_at_the_files_ids_also_where_an_id_repeats(spark):
    rows = [(5, f"text {'word ' * (i * 7 % 12)}{i}") for i in range(12)] + [(5, None), (None, "no id"), (None, None), (9, "last"), (1, "first")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    folder = fresh_path(spark, "t_tokens")
    token_files.write_tokens(docs, folder)
    stored = token_files.read_tokens(spark, folder).orderBy("block", "row").collect()
    whole = [x for r in stored for x in r["ids"]]
    assert [r["doc_id"] for r in stored] == sorted([r[0] for r in rows], key=lambda d: (d is not None, d or 0))
    import zlib

    import numpy as np

    for r in token_files.token_digests(spark, folder).collect():
        ids = whole[r["start"] : r["start"] + r["n_tokens"]]
        assert zlib.crc32(np.array(ids, "<u4").tobytes()) == r["ids_crc32"]


def test_empty_table(spark):
    folder = fresh_path(spark, "t_tokens")
    token_files.write_tokens(spark.createDataFrame([], "doc_id long, text string"), folder)
    assert token_files.token_digests(spark, folder).where(F.lit(True)).collect() == []


def test_blocks_are_bounded_in_number():
    assert [positions.blocks_for(n) for n in (0, 1, 16384, 16385, 10**11, 10**14)] == [1, 1, 1, 2, 100_000, 100_000]
