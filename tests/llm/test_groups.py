"""Links found inside groups: op8 and op12 against brute force, wide groups, small blocks, clashing names."""

import numpy as np
import pytest

from tests.llm import messy
from tests.llm.messy import in_order
from upcharts.llm import groups, near_dedup, parity_join


def _joined(docs):
    return in_order(parity_join.ngram_join(docs).collect())


def _brute(rows):
    return in_order((d, n, c) for d, n, c, _ in messy.brute_near(rows, 3, 90))


def test_ngram_join_on_awkward_rows(spark):
    rows = messy.messy_rows()
    docs = spark.createDataFrame(rows, messy.SCHEMA).repartition(3)
    assert _joined(docs) == _brute([r[:2] for r in rows])


def test_ngram_join_of_short_texts(spark):
    """Few shingles: pairs of parts, and sizes at the bounds of the bands."""
    random = np.random.default_rng(4)
    rows = []
    for n in range(3, 60):
        words = [f"w{random.integers(0, 10**6)}" for _ in range(n)]
        for changes in range(3):
            changed = list(words)
            for at in random.choice(n, min(n, changes), replace=False):
                changed[at] = f"c{random.integers(0, 10**6)}"
            rows.append((len(rows), " ".join(changed[: n - int(random.integers(0, 2))])))
    got = _joined(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == _brute(rows) and len({r[2] for r in got}) < len(rows)


def test_null_and_repeated_ids(spark):
    rows = [(None, "a b c d"), (None, "x y z"), (5, "a b c d"), (5, "k l m n o"), (2, "k l m n o"), (9, ""), (9, None), (7, "x  Y z")]
    assert _joined(spark.createDataFrame(rows, "doc_id long, text string")) == _brute(rows)


def test_no_rows(spark):
    empty = spark.createDataFrame([], messy.SCHEMA)
    assert parity_join.ngram_join(empty).collect() == []
    assert near_dedup.near_groups(empty).collect() == []
    assert near_dedup.drop_near_copies(empty).collect() == []


def _chain(texts: int, step: int, words: int = 160) -> list[tuple]:
    """Texts of one passage in which each replaces further words, so that only neighbours are near."""
    body = [f"w{i}" for i in range(words)]
    rows = []
    for i in range(texts):
        for at in range(i * step, i * step + step):
            # the first words stay: all texts share parts of their sketches
            body[40 + at % (words - 40)] = f"t{at}"
        rows.append((i, " ".join(body)))
    return rows


@pytest.mark.parametrize("block", [groups.BLOCK, 40_000])
def test_a_chain_of_neighbours_is_one_component(spark, monkeypatch, block):
    monkeypatch.setattr(groups, "BLOCK", block)
    rows = _chain(1500, 2) + [(10_000 + i, " ".join([*[f"w{k}" for k in range(40)], *[f"u{i}x{k}" for k in range(120)]])) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_groups(docs).collect()}
    assert {got[i] for i in range(1500)} == {0}
    assert all(got[10_000 + i] == 10_000 + i for i in range(1500))


def test_group_rows_do_not_grow_with_pairs():
    random = np.random.default_rng(1)
    base = np.sort(random.integers(0, 1 << 62, 200, dtype=np.int64).astype(np.uint64))
    sets = [np.unique(np.concatenate((np.delete(base, random.choice(200, 6)), random.integers(0, 1 << 62, 6).astype(np.uint64)))) for _ in range(400)]
    links = groups.spanning_links(sets, np.arange(400), np.zeros(400, int), lambda i, j: j, 80)
    assert 0 < len(links) <= 399


def test_sketch_distance_never_exceeds_the_difference():
    random = np.random.default_rng(2)
    layout = parity_join.Layout(90)
    for n in (1, 8, 9, 10, 20, 37, 150, 2000):
        a = np.unique(random.integers(0, 1 << 63, n, dtype=np.int64).astype(np.uint64))
        for apart in range(0, max(1, n // 12)):
            b = np.unique(np.concatenate((a[apart // 2 :], random.integers(0, 1 << 63, apart - apart // 2, dtype=np.int64).astype(np.uint64))))
            differ = len(np.setxor1d(a, b))
            for band in {layout.band(len(a)), layout.band(len(b))}:
                bits = np.bitwise_count(layout.sketch(a, band) ^ layout.sketch(b, band)).sum()
                assert bits <= differ
            low = min(layout.band(len(a)), layout.band(len(b)))
            both = len(np.intersect1d(a, b))
            if differ and abs(layout.band(len(a)) - layout.band(len(b))) <= 1 and 100 * both >= 90 * len(np.union1d(a, b)):
                assert len(np.intersect1d(layout.keys(a, low), layout.keys(b, low)))


def random_sets(seed, sets, n):
    random = np.random.default_rng(seed)
    return [np.unique(random.integers(0, 1 << 64, n, dtype=np.uint64)) for _ in range(sets)]


def test_unrelated_sets_share_no_key():
    """Parts that are almost empty, or whose sketches look alike, would bring more sets together the larger the table is."""
    layout = parity_join.Layout(90)
    keys = [layout.keys(s, layout.band(150)) for s in random_sets(3, 3000, 150)]
    assert {len(k) for k in keys} == {layout.apart(layout.band(150)) + 1}
    flat = np.concatenate(keys)
    assert len(np.unique(flat)) == len(flat)


def test_sets_at_the_limit_share_a_key():
    """As many shingles as may differ, most of them in the fullest parts of one set."""
    layout = parity_join.Layout(90)
    for n in (10, 40, 60, 150, 600):
        for a in random_sets(n, 20, n):
            band = layout.band(n)
            part = layout.part(a, band)
            full = np.argsort(-np.bincount(part.astype(np.int64), minlength=layout.parts(band)), kind="stable")
            # one shingle of each part, from the fullest on, as long as the sets still link
            gone = [int(np.flatnonzero(part == p)[0]) for p in full.tolist() if (part == p).any()][: n // 10]
            b = np.delete(a, gone)
            assert 100 * len(b) >= 90 * len(a)
            low = layout.band(len(b))
            assert low in (band - 1, band)
            assert len(np.intersect1d(layout.keys(a, low), layout.keys(b, low)))


def test_columns_with_inner_names_stay(spark):
    rows = [(*r, 1, 2, "x", 3, 4, 5, 6) for r in messy.messy_rows()]
    docs = spark.createDataFrame(rows, messy.CLASHING)
    kept = near_dedup.drop_near_copies(docs)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    assert {tuple(r) for r in kept.select("_id", "_check", "_keep", "_digest").collect()} == {(1, 2, 4, "x")}
    assert parity_join.ngram_join(docs).count() == len(rows)
