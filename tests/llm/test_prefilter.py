"""Rows that no key names are left out before a join, and nothing else is."""

import pytest
from pyspark.sql import functions as F

from upcharts.llm import exact_dedup, groups, near_dedup, prefilter
from upcharts.session import fresh_path


@pytest.mark.parametrize("slots", [1, 40_000, prefilter.SLOTS])
def test_no_row_with_a_partner_is_left_out(spark, monkeypatch, slots):
    monkeypatch.setattr(prefilter, "SLOTS", slots)
    rows = spark.range(5000).select(F.when(F.col("id") % 100 != 0, F.col("id")).alias("a"), (F.col("id") * 7).alias("b"))
    keys = rows.where("b % 3 = 0")
    marked = prefilter.marked(rows, keys, ["a", "b"])
    assert marked.columns == ["a", "b", "_maybe"] and marked.count() == 5000
    assert marked.where("b % 3 = 0 AND NOT _maybe").count() == 0
    others = marked.where("b % 3 != 0 AND _maybe").count()
    assert others == 3333 if slots == 1 else others < 3333 * (0.1 if slots < 50_000 else 0.01)


def test_without_keys_no_row_is_marked(spark):
    rows = spark.range(10)
    assert prefilter.marked(rows, rows.where("id < 0"), ["id"]).where("_maybe").count() == 0


def _shuffled(spark, run) -> int:
    """Rows of texts that a join or aggregate was given."""
    seen = []
    plain = prefilter.marked

    def counted(rows, keys, of, name="_maybe"):
        out = plain(rows, keys, of, name)
        seen.append((out.count(), out.where(name).count()))
        return out

    patch = pytest.MonkeyPatch()
    for module in (exact_dedup, groups, near_dedup):
        patch.setattr(module, "marked", counted)
    try:
        run().collect()
    finally:
        patch.undo()
    return seen


def test_texts_without_copies_are_not_shuffled(spark):
    """60 texts of their own, two copies and one near copy: the joins see few of the texts."""
    texts = [" ".join(f"t{i}w{k}" for k in range(60)) for i in range(60)]
    rows = [*enumerate(texts), (60, texts[0]), (61, texts[1] + " more")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ((total, maybe),) = _shuffled(spark, lambda: exact_dedup.drop_copies(docs, fresh_path(spark, "t_index")))
    assert (total, maybe) == (62, 1)
    held, gone = _shuffled(spark, lambda: near_dedup.drop_near_copies(docs))
    assert held == (62, 2) and gone[0] == 62 and gone[1] in (1, 2)
