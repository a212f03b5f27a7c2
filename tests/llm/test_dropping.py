"""Operators that return rows of the table: no rows, clashing names, several blocks, sequences."""

from collections import defaultdict

from tests.llm import messy
from upcharts.llm import decontamination, exact_dedup, language_id, line_dedup, near_dedup, packing
from upcharts.session import fresh_path

ITEM = "which of these seven unusual planets keeps the longest winter of them all"


def _docs(spark):
    rows = [(*r, 1, 2, "x", 3, 4, 5, 6) for r in messy.messy_rows()]
    rows.append((1000, f"some words before it {ITEM} and some behind", *rows[0][2:]))
    return spark.createDataFrame(rows, messy.CLASHING)


def _benchmark(spark):
    items = [(i, f"{w} is an item of the benchmark that no document holds anywhere") for i, w in enumerate(["one", "two", "three", "four"])]
    return spark.createDataFrame([*items, (9, ITEM), (10, None), (None, "")], "item_id long, text string")


def test_leaks_are_dropped_in_one_block_or_several(spark):
    docs, benchmark = _docs(spark), _benchmark(spark)
    assert len(decontamination.item_blocks(benchmark, 100)) > 1
    for size in (decontamination.BLOCK_BYTES, 100):
        kept = decontamination.drop_leaks(docs, benchmark, size)
        assert kept.columns == docs.columns
        got = messy.in_order(kept.collect())
        assert got == messy.in_order(r for r in docs.collect() if ITEM not in (r["text"] or ""))


def test_no_rows_to_drop(spark):
    docs, benchmark = _docs(spark), _benchmark(spark)
    empty = docs.limit(0)
    model = language_id.train(docs)
    for out in (
        decontamination.drop_leaks(empty, benchmark),
        language_id.drop_unidentified(empty, model),
        exact_dedup.drop_copies(empty, fresh_path(spark, "t_none")),
        near_dedup.drop_near_copies(empty),
        line_dedup.dedup_lines(empty),
    ):
        assert out.columns == docs.columns and out.collect() == []
    assert decontamination.drop_leaks(docs, benchmark.limit(0)).count() == docs.count()
    assert packing.packed_sequences(empty, packing.pack_documents(empty)).collect() == []


def test_packed_sequences_hold_the_ids_of_their_pieces(spark):
    rows = [(i, f"text {'word ' * (i * 37 % 400)}{i}") for i in range(40)] + [(41, None), (42, "long text " * 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    packed = packing.pack_documents(docs)
    sequences = {r["sequence_id"]: list(r["ids"]) for r in packing.packed_sequences(docs, packed).collect()}
    whole = defaultdict(list)
    for r in sorted(packed.collect(), key=lambda r: (r["doc_id"], r["piece"])):
        ids = sequences[r["sequence_id"]]
        assert len(ids) <= packing.CAPACITY
        part = ids[r["offset"] : r["offset"] + r["length"]]
        assert messy.crc(part) == r["ids_crc32"]
        whole[r["doc_id"]] += part
    plain = packing.token_pieces(docs, 1 << 30, with_ids=True).collect()
    assert whole == {r["doc_id"]: list(r["ids"]) for r in plain}
    assert sum(map(len, sequences.values())) == sum(map(len, whole.values()))
