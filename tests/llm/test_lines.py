"""Line dedup: short lines, blank CRLF lines, very long lines, hot variants and clashing names."""

import time

from pyspark.sql import functions as F

from tests.llm import messy
from tests.llm.test_operators import brute_lines
from upcharts.llm import line_dedup


def _removed(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = {r["doc_id"]: r["removed_lines"] for r in line_dedup.line_report(docs).collect()}
    return {d: {int(x) for x in lines.split(",")} for d, lines in out.items() if lines}


def test_lines_of_few_words(spark):
    lines = ["a b c d", "a b c", "a b x d", "a b c d e", "a b", "a c", "x y z", "x y w", "p q r s", "q r s", "p q r", "one two  three", "one two three"]
    lines += ["a b c d e f g", "a b c d e f g h", "b c d e f g h", "a a b b a a b", "a a b a a b", "a b a a b b a"]
    rows = [(i, line) for i, line in enumerate(lines)] + [(99, "\n".join(reversed(lines)))]
    assert _removed(spark, rows) == dict(brute_lines(rows))


def test_blank_lines_stay(spark):
    text = "first\r\n\r\nsecond\r\n\r\nthird\n \t\n \t\n"
    docs = spark.createDataFrame([(1, text), (2, "\r\n\r\nother")], "doc_id long, text string")
    assert {r["text"] for r in line_dedup.dedup_lines(docs).collect()} == {text, "\r\n\r\nother"}


def test_very_long_lines(spark):
    words = [f"w{i}" for i in range(100_000)]
    near = [*words[:70_000], "changed", *words[70_001:]]
    cut = [*words[:30_000], *words[30_001:]]
    rows = [(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(cut)), (4, " ".join(reversed(words)))]
    began = time.perf_counter()
    assert _removed(spark, rows) == {2: {0}, 3: {0}}
    assert time.perf_counter() - began < 60


def test_a_variant_that_many_lines_share(spark):
    rows = [(i, f"item {i} of the long list\nsee page {i} of the long list") for i in range(3000)]
    got = _removed(spark, rows)
    assert got == {i: {0, 1} for i in range(1, 3000)}


def test_columns_with_inner_names_stay(spark):
    rows = [(*r, 1, 2, "x", 3, 4, 5, 6) for r in messy.messy_rows()]
    docs = spark.createDataFrame(rows, messy.CLASHING)
    kept = line_dedup.dedup_lines(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows)
    assert {tuple(r) for r in kept.select("_id", "_check", "_gone").collect()} == {(1, 2, 3)}
    assert line_dedup.dedup_lines(docs.limit(0)).collect() == []
    assert kept.where(F.col("text").isNull()).count() == docs.where(F.col("text").isNull()).count()
