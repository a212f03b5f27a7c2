import time

import pyarrow as pa

from upcharts.operators import matching

CANDIDATES = "name string, artist_id string, score int, tags array<string>, error string"


def _match(spark, candidates, *names):
    primaries = spark.createDataFrame([(n,) for n in names], "primary_artist_used string")
    result = matching.match_artists(primaries, spark.createDataFrame(candidates, CANDIDATES))
    return {r.primary_artist_used: r for r in result.collect()}


def test_threshold_applies_to_the_best_answer(spark):
    got = _match(
        spark,
        [
            ("below", "i1", 79, ["rock"], None),
            ("reaches", "i2", 80, None, None),
            ("unscored", "i3", None, ["rock"], None),
            ("several", "b", 90, ["rock"], None),
            ("several", "a", 90, ["pop"], None),
            ("several", "c", 85, ["jazz"], None),
            ("broken", None, None, None, "timeout"),
            ("retried", None, None, None, "timeout"),
            ("retried", "i9", 99, ["pop"], None),
        ],
        "below", "reaches", "unscored", "several", "broken", "retried", "absent",
    )
    assert {name: r.status for name, r in got.items()} == {
        "below": "unmatched",
        "reaches": "matched",
        "unscored": "unmatched",
        "several": "matched",
        "broken": "failed",
        "retried": "matched",
        "absent": "unmatched",
    }
    assert (got["several"].mbid, got["several"].tags) == ("a", ["pop"])
    assert (got["reaches"].tags, got["below"].tags, got["below"].mbid) == ([], [], None)
    assert got["broken"].error == "timeout" and not got["broken"].found


def test_lookup_equals_map_then_fan_out(spark):
    entries = spark.createDataFrame(
        [("A",), ("A & B",), ("A, C",), ("D",), ("A",)], "artist string"
    )
    candidates = spark.createDataFrame([("A", "i1", 95, ["pop"], None)], CANDIDATES)
    credits = matching.credit_map(matching.unique_credits(entries))
    primaries = credits.select("primary_artist_used").distinct()
    separate = matching.fan_out(credits, matching.match_artists(primaries, candidates))
    direct = matching.lookup_artists(entries, candidates)
    assert direct.columns == separate.columns
    assert sorted(map(repr, direct.collect())) == sorted(map(repr, separate.collect()))
    assert {r.artist: r.mbid for r in direct.collect()} == {"A": "i1", "A & B": "i1", "A, C": "i1", "D": None}


def _plain_scores(names, catalogue, threshold):
    def grams(x):
        x = f"  {x.strip(' ').lower()}  "
        return {x[i : i + 3] for i in range(len(x) - 2)}

    scores = {(n, c): 200 * len(grams(n) & grams(c)) // (len(grams(n)) + len(grams(c))) for n in names for c in catalogue}
    return {(*pair, score) for pair, score in scores.items() if score >= threshold}


def test_names_are_compared_block_by_block(spark, monkeypatch):
    """Common grams join no rows: each pair meets once, in the task of its two blocks."""
    monkeypatch.setattr(matching, "NAME_BLOCK", 8)
    monkeypatch.setattr(matching, "CANDIDATE_BLOCK", 5)
    names = [f"Brand#{i % 4} Act {i * 7}{' & Friends' if i % 3 == 0 else ''}" for i in range(60)] + ["", "x"]
    catalogue = [f"Brand#{i % 5} Act {i * 3}" for i in range(40)] + ["X", "y"]
    for threshold in (30, 60, 80, 100):
        got = matching.name_scores(
            spark.createDataFrame([(n,) for n in [*names, *names]], "name string"), spark.createDataFrame([(c,) for c in [*catalogue, None]], "candidate string"), threshold
        )
        pairs = [tuple(r) for r in got.collect()]
        assert len(pairs) == len(set(pairs)) and set(pairs) == _plain_scores(names, catalogue, threshold)


def test_names_of_any_length_and_grams_of_any_size(spark, monkeypatch):
    """Counts over 255, grams of one letter, rows of common grams that do not fit and batches of few pairs change nothing."""
    monkeypatch.setattr(matching, "PAIRS_AT_ONCE", 7)
    long = "".join(chr(0x4E00 + i) for i in range(700))
    names = ["", " ", "a", "ab", "Ab ", "abba", "b\u00e9b\u00e9 \U0001f600", long, long[:300], long[:253], "x" * 400]
    catalogue = ["", "A", "ba", "abb", "B\u00c9B\u00c9 \U0001f600", long[:690], long[100:], "xx"]

    def grams(x, q):
        x = " " * (q - 1) + x.strip(" ").lower() + " " * (q - 1)
        return {x[i : i + q] for i in range(len(x) - q + 1)} or {""}

    for q, threshold, room in ((1, 50, 1 << 20), (2, 30, 0), (3, 1, 1 << 20), (3, 80, 100), (4, 0, 1 << 20)):
        monkeypatch.setattr(matching, "DENSE_BYTES", room)
        got = matching.name_scores(spark.createDataFrame([(n,) for n in names], "name string"), spark.createDataFrame([(c,) for c in catalogue], "candidate string"), threshold, q)
        pairs = [(n, c, grams(n, q), grams(c, q)) for n in names for c in catalogue]
        expected = {(n, c, 200 * len(a & b) // (len(a) + len(b))) for n, c, a, b in pairs if a & b and 200 * len(a & b) >= threshold * (len(a) + len(b))}
        rows = [tuple(r) for r in got.collect()]
        assert len(rows) == len(set(rows)) and set(rows) == expected


def test_best_answers_only(spark):
    """Names whose grams a candidate has are answered without a search; outcomes stay the same."""
    names = spark.createDataFrame([(n,) for n in ("The Beatles", "the beatles ", "The Beatlez", "Queen", "Nobody", None)], "name string")
    catalogue = spark.createDataFrame(
        [("The Beatles", "id-2", ["rock"]), ("THE BEATLES", "id-1", None), ("The Beatless", "id-0", ["pop"]), ("Queens", "id-3", ["rock"]), (None, "id-9", ["rock"])],
        "candidate string, artist_id string, tags array<string>",
    )
    asked = names.withColumnRenamed("name", "primary_artist_used")
    answers = [matching.scored_candidates(names, catalogue, 70, best_only=best) for best in (False, True)]
    every, best = [{tuple(map(str, r)) for r in matching.match_artists(asked, a, 70).collect()} for a in answers]
    assert every == best and len(every) == 6
    assert {(r.name, r.artist_id, r.score) for r in answers[1].collect() if r.name == "The Beatles"} == {("The Beatles", "id-2", 100), ("The Beatles", "id-1", 100)}


def test_a_pair_of_names_takes_nanoseconds():
    """Names searched for are compared with a block of candidates at once: 67 million pairs in under two seconds."""

    def block(texts):
        columns = [pa.array([0] * len(texts), pa.int32()), pa.array([f"  {t.lower()}  " for t in texts]), pa.array(texts)]
        (row,) = matching._block_index(3)([pa.RecordBatch.from_arrays(columns, names=["block", "closed", "text"])])
        return row

    names = [f"Brand#{i % 50} Act {i * 37 % 90001} x Echo" for i in range(4096)]
    catalogue = [f"Brand#{i % 50} Act {i * 37 % 90001}" for i in range(16384)]
    (asked,), (held,) = (block(texts).column("data").to_pylist() for texts in (names, catalogue))
    both = pa.RecordBatch.from_arrays([pa.array([0, 0]), pa.array([False, True]), pa.array([held, asked], pa.binary())], names=["pair", "is_name", "data"])
    began = time.process_time()
    found = [r for batch in matching._block_scores(80)([both]) for r in batch.to_pylist()]
    assert time.process_time() - began < 2
    assert {(r["name"], r["candidate"], r["score"]) for r in found if r["name"] in names[:4]} == _plain_scores(names[:4], catalogue, 80)
