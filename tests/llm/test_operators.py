"""Each operator against a brute-force version on awkward rows, and on no rows."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from tests.llm import messy
from tests.llm.messy import crc, in_order
from upcharts.llm import (
    decontamination,
    exact_dedup,
    language_id,
    line_dedup,
    near_dedup,
    packing,
    sharding,
    substring_dedup,
    token_files,
    toxicity,
)
from upcharts.llm.tokens import vocabulary_path
from upcharts.session import fresh_path


@pytest.fixture(scope="module")
def rows():
    return messy.messy_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, messy.SCHEMA)


@pytest.fixture(scope="module")
def pairs(rows):
    return [r[:2] for r in rows]


@pytest.fixture(scope="module")
def whole_ids(pairs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary_path())
    return [(d, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]) for d, t in pairs]


def brute_lines(pairs):
    """Removed line numbers of each row, by comparing each line with all before it."""
    places = []
    for d, t in pairs:
        for no, line in enumerate(t.split("\n") if t is not None else []):
            if line.strip(" \t\x0b\x0c\r"):
                places.append((messy_id(d), no, line.split(" ")))
    places.sort(key=lambda p: p[:2])

    def near(a, b):
        if a == b:
            return True
        if max(len(a), len(b)) < 4 or abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    gone = defaultdict(set)
    for i, (d, no, line) in enumerate(places):
        if any(p[:2] != (d, no) and near(p[2], line) for p in places[:i]):
            gone[d].add(no)
    return gone


def messy_id(d):
    return -(1 << 63) if d is None else d


def test_lines(docs, pairs):
    gone = brute_lines(pairs)
    for r in line_dedup.line_report(docs).collect():
        expected = sorted(gone[messy_id(r["doc_id"])])
        assert r["removed_lines"] == ",".join(map(str, expected)), r
    texts = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(docs).collect()}
    for d, t in pairs:
        kept = None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[messy_id(d)])
        assert texts[d] == kept


def test_word_distance(spark):
    cases = [("a b", "a b", True), ("a b", "a c", True), ("a b", "b", True), ("b", "a b", True), ("a b c", "c b a", False), ("a b c", "a", False), ("a", "b c", False)]
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(x.split(), y.split(), e) for x, y, e in cases], "x array<string>, y array<string>, e boolean")
    assert df.where(line_dedup.within_one_word(F.col("x"), F.col("y")) != F.col("e")).count() == 0


def test_token_files(spark, docs, whole_ids):
    folder = fresh_path(spark, "t_tokens")
    token_files.write_tokens(docs, folder)
    got = token_files.token_digests(spark, folder).collect()
    assert in_order((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == in_order((d, len(i), crc(i)) for d, i in whole_ids)
    got.sort(key=lambda r: r["start"])
    assert [r["start"] for r in got] == np.cumsum([0, *[r["n_tokens"] for r in got[:-1]]]).tolist()
    assert [messy_id(r["doc_id"]) for r in got] == sorted(messy_id(d) for d, _ in whole_ids)


def test_exact(spark, docs, pairs):
    path = fresh_path(spark, "t_index")
    assert in_order(exact_dedup.dedup_against(docs, path, 8).collect()) == in_order(messy.brute_exact(pairs))
    # a second batch loses what the index holds
    more = spark.createDataFrame([(900, "HeLLo"), (901, "new here"), (902, "NEW HERE")], "doc_id long, text string")
    found = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.dedup_against(more, path, 8).collect()}
    # three copies of hello were there
    hello = max(d for d, t in pairs if t and t.lower() == "hello")
    assert found == {900: (hello, 4, False), 901: (902, 2, False), 902: (902, 2, True)}


def test_exact_in_batches(spark, docs, pairs):
    for batches in (1, 3, 7):
        got = exact_dedup.dedup_against(docs, fresh_path(spark, "t_index"), 8, batches)
        assert in_order(got.collect()) == in_order(messy.brute_exact(pairs))


def test_exact_with_a_hot_text(spark):
    """A third of the rows are one text: no task gathers them, and the index decides later batches."""
    rows = [(i, "the hot text" if i % 3 == 0 else f"text {i // 2}") for i in range(6000)] + [(None, "THE hot text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = exact_dedup.dedup_against(docs, fresh_path(spark, "t_index"), 8, 3)
    assert in_order(got.collect()) == in_order(messy.brute_exact(rows))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan


def test_dropped_copies_leave_columns_alone(spark):
    rows = [(*r, 1, 2, "x", 3, 4, 5, 6) for r in messy.messy_rows()]
    docs = spark.createDataFrame(rows, messy.CLASHING)
    kept = exact_dedup.drop_copies(docs, fresh_path(spark, "t_index"))
    assert kept.columns == docs.columns
    expected = [r[0] for r in messy.brute_exact([r[:2] for r in rows]) if r[3]]
    assert in_order((r["doc_id"],) for r in kept.collect()) == in_order((d,) for d in expected)
    assert {tuple(r) for r in kept.select("_digest", "_keep").collect()} == {("x", 4)}
    assert exact_dedup.drop_copies(docs.limit(0), fresh_path(spark, "t_index")).collect() == []


def test_shards(docs, pairs):
    got = sharding.add_law(sharding.shard_by_bytes(docs)).collect()
    size = lambda t: len((t or "").encode()) + 1
    assert in_order((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == in_order((d, size(t), zlib.crc32((t or "").encode())) for d, t in pairs)
    slots, homes = defaultdict(list), defaultdict(set)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        homes[r["text_crc32"]].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(16))
    assert all(len(h) == 1 for h in homes.values())


def test_shard_room_is_levelled():
    ends = sharding._cuts([10.0, 0.0, 4.0], 9)
    assert np.allclose(np.diff([0, *ends]), [0, 6.5, 2.5])


def test_language(spark):
    sets = {"aa": "lorum tessit minna ", "bb": "ghax qqiv wuzz ", "cc": "éèê ñoço üß "}
    data = [(i, sets[k] * (3 + i % 5), k) for i in range(90) for k in [sorted(sets)[i % 3]]]
    data += [(200, None, "aa"), (201, "12 34 €", "bb"), (202, "", None), (None, sets["cc"] * 3, "cc")]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    model = language_id.train(docs)
    got = {r["doc_id"]: r for r in language_id.identify(docs, model).collect()}
    assert all(got[d]["lang_pred"] == k and 0 <= got[d]["score"] <= 1 for d, _, k in data[:90])
    assert all(got[d]["lang_pred"] == "und" and got[d]["score"] == 0 for d in (200, 201, 202))
    assert got[None]["lang_pred"] == "cc" and not got[None]["held_out"]
    assert got[3]["held_out"] == (zlib.crc32(b"3") % 5 == 0)
    assert language_id.drop_unidentified(docs, model).count() == 91


def test_language_gradients():
    model = language_id.Model.fresh(["a", "b"])
    for w in model.parameters():
        w *= 0.5
    model.front = language_id.Direction(*[w.astype(np.float64) for w in (model.front.table, model.front.state)])
    random = np.random.default_rng(1)
    codes, goal = random.integers(97, 100, (5, 4)).astype(np.uint8), np.array([0, 1, 0, 1])
    letters = np.ones((5, 4), np.float32)

    def loss():
        p = model.positions(codes)
        return -np.log(p[:, np.arange(4), goal]).mean()

    found = model.gradients(codes, letters, goal)
    for at in [(97, 3), (98, 12), (99, 20)]:
        keep = model.front.table[at]
        model.front.table[at] = keep + 1e-3
        up = loss()
        model.front.table[at] = keep - 1e-3
        down = loss()
        model.front.table[at] = keep
        assert found[0][at] == pytest.approx((up - down) / 2e-3, abs=2e-4)


@pytest.mark.skipif("not __import__('os').path.isdir('/root/testdata/sf0.01')")
def test_toxicity(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    scorer = toxicity.train(docs, labels)
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    got = [r for r in toxicity.score(docs, scorer).collect() if r["doc_id"] in truth]
    bad = [r["score"] for r in got if truth[r["doc_id"]] == 1]
    good = [r["score"] for r in got if truth[r["doc_id"]] == 0]
    assert np.mean([b > g for b in bad for g in good]) > 0.9
    for masked, plain in {"i d i o t": "idiot", "l0ser": "loser", "$tup1d": "stupid", "m.o.r.o.n": "moron"}.items():
        data = np.frombuffer(masked.encode(), np.uint8)
        restored, _ = toxicity.Restorer(scorer.model).texts(data, np.array([0, len(data)]))
        assert restored.tobytes().decode().strip() == plain
    odd = spark.createDataFrame([(None, None), (1, ""), (2, "1" * 3000 + "a")], "doc_id long, text string")
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(odd, scorer).collect()}
    assert len(scores) == 3 and scores[None] == scores[1]


def test_repeats(docs, pairs):
    got = substring_dedup.remove_repeats(docs, with_text=True).collect()
    assert in_order(r[:4] for r in got) == in_order(messy.brute_repeats(pairs))
    assert sum(r["n_removed"] for r in got) > 0


def test_repeats_in_short_windows(docs, pairs):
    got = substring_dedup.remove_repeats(docs, window=5).collect()
    assert in_order(got) == in_order(messy.brute_repeats(pairs, 5))


def test_near(docs, pairs):
    assert in_order(near_dedup.near_groups(docs).collect()) == in_order(messy.brute_near(pairs))


def test_decontamination(spark, docs):
    item = "which of the seven northern rivers reaches the sea before the others do in spring"
    items = spark.createDataFrame([(1, item), (2, None), (3, "short"), (4, item.upper())], "item_id long, text string")
    edited = item.replace("seven", "sevin").replace("others", "other")
    texts = [f"before {item} after", f"a {edited}. b", "nothing of it", None, "", f"{item[:40]} cut", f"{item}  {item}"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").unionByName(docs.select("doc_id", "text"))
    got = sorted(tuple(r)[:3] for r in decontamination.find_leaks(frame, items).collect())
    assert got == sorted((d, i, e) for d, e in ((0, 0), (1, 2), (6, 0)) for i in (1, 4))
    again = sorted(tuple(r)[:3] for r in decontamination.find_leaks(frame, items, block_bytes=50).collect())
    assert again == got
    assert decontamination.drop_leaks(frame, items).count() == frame.count() - 3


def test_myers_is_edit_distance():
    def brute(p, t):
        row = list(range(len(p) + 1))
        best = row[-1]
        for c in t:
            new = [0]
            for i, x in enumerate(p):
                new.append(min(row[i] + (x != c), row[i + 1] + 1, new[i] + 1))
            row = new
            best = min(best, row[-1])
        return best

    random = np.random.default_rng(2)
    for _ in range(300):
        p, t = (bytes(random.integers(97, 100, random.integers(1, n)).tolist()) for n in (12, 30))
        assert decontamination.myers(p, t)[0] == brute(p, t)


def test_packing(docs, whole_ids):
    got = packing.pack_documents(docs).collect()
    expected = [
        (d, k, k * 4096, len(i[k * 4096 : (k + 1) * 4096]), crc(i[k * 4096 : (k + 1) * 4096]))
        for d, i in whole_ids
        for k in range(-(-len(i) // 4096))
    ]
    assert in_order(r[:5] for r in got) == in_order(expected)
    held = defaultdict(list)
    for r in got:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in held.values():
        ends = np.cumsum([0, *[n for _, n in sorted(parts)]]).tolist()
        assert [o for o, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 4096


def test_packing_plan_is_tight_and_complete():
    random = np.random.default_rng(4)
    for capacity in (50, 300):
        lengths = random.integers(1, capacity + 1, 3000)
        counts = np.bincount(lengths, minlength=capacity + 1)
        plan = packing.plan_packing(counts, capacity)
        used = Counter()
        for parts, times in plan:
            assert sum(parts) <= capacity and times > 0
            for p in parts:
                used[p] += times
        assert used == Counter(lengths.tolist())
        best = max(-(-int(lengths.sum()) // capacity), int((lengths * 2 > capacity).sum()))
        assert sum(t for _, t in plan) <= best * 1.03 + 1


def test_pipeline_stages_on_awkward_rows(spark, docs, tmp_path):
    items = spark.createDataFrame([(1, "the quick brown fox jumps over it and runs into the woods")], "item_id long, text string")
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    given = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, given, str(tmp_path))
        assert out.columns == docs.columns
        path = fresh_path(spark, "t_stage")
        out.write.parquet(path)
        assert spark.read.parquet(path).count() <= given.count()
        given = spark.read.parquet(path)
    packed = corpus_pipeline.STAGES[-1][1](spark, given, str(tmp_path))
    assert packed.select("doc_id").distinct().count() == given.select("doc_id").distinct().count()


EMPTY = {
    "lines": line_dedup.line_report,
    "exact": lambda d: exact_dedup.dedup_against(d, fresh_path(d.sparkSession, "t_none")),
    "shards": sharding.shard_by_bytes,
    "language": lambda d: language_id.identify(d, language_id.train(d)),
    "toxicity": lambda d: toxicity.score(d, toxicity.train(d, d.select("doc_id", d["doc_id"].cast("int").alias("toxic")))),
    "repeats": substring_dedup.remove_repeats,
    "near": near_dedup.near_groups,
    "leaks": lambda d: decontamination.find_leaks(d, d.select(d["doc_id"].alias("item_id"), "text")),
    "packing": packing.pack_documents,
}


@pytest.mark.parametrize("name", EMPTY)
def test_no_rows(spark, name):
    assert EMPTY[name](spark.createDataFrame([], messy.SCHEMA)).count() == 0
