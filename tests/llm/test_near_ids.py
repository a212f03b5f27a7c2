"""Near-duplicate groups where doc_ids are null or occur with several texts."""

import numpy as np

from tests.llm import messy
from tests.llm.messy import in_order
from upcharts.llm import near_dedup, text


def _rows():
    random = np.random.default_rng(8)
    words = [f"w{i}" for i in range(500)]
    base, other, third = (list(random.choice(words, 80)) for _ in range(3))

    def near(words, at):
        return " ".join([*words[:at], "changed", *words[at + 1 :]])

    return [
        (None, " ".join(base)), (None, near(base, 9)), (None, " ".join(other)),
        (5, near(other, 30)), (5, " ".join(third)), (5, ""), (9, near(third, 60)), (2, near(third, 5)), (7, "alone here"), (8, None),
    ]


def test_groups_with_null_and_repeated_ids(spark):
    rows = _rows()
    for part in (rows, rows[:3], rows[3:], rows[1:5]):
        docs = spark.createDataFrame(part, "doc_id long, text string").repartition(3)
        assert in_order(near_dedup.near_groups(docs).collect()) == in_order(messy.brute_near(part))


def test_near_copies_without_ids_are_dropped(spark):
    docs = spark.createDataFrame([*_rows(), _rows()[8]], "doc_id long, text string")
    got = near_dedup.drop_near_copies(docs).collect()
    # one text about base, other and third each, all that is alone or has no words; equal rows share their fate
    assert sum(r["text"] in (_rows()[0][1], _rows()[1][1]) for r in got) == 1
    ids = sorted((r["doc_id"] or 0, r["text"] or "") for r in got)
    assert (2, _rows()[7][1]) in ids and (5, "") in ids and (8, "") in ids and ids.count((7, "alone here")) == 2
    assert len(got) == 7 and (0, _rows()[2][1]) in ids


def test_rows_are_told_apart_by_64_bits(spark):
    assert dict(spark.createDataFrame([(1, "a")], "doc_id long, text string").select(*text.row_key()).dtypes)["_check"] == "bigint"


def test_copies_are_dropped_on_shingles_of_five_words(spark):
    words = [f"w{i}" for i in range(45)]
    changed = ["changed" if i == 20 else w for i, w in enumerate(words)]
    # one word of 45: 38 of 46 shingles of four words, 36 of 46 of five
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(changed))], "doc_id long, text string")
    assert [near_dedup.drop_near_copies(docs, shingle=k).count() for k in (4, 5)] == [1, 2]
    assert near_dedup.drop_near_copies(docs).count() == 2
    assert sum(r["kept"] for r in near_dedup.near_groups(docs).collect()) == 1
