"""What keeps shuffled and written bytes low as the history grows."""

import re

import pytest
from pyspark.sql.classic.dataframe import DataFrame
from pyspark.sql import functions as F

from tests.conftest import DEBUT, rows
from upcharts import registry, session
from upcharts.operators import cohort, matching, quality, staging
from upcharts.plans import warehouse
from upcharts.plans.warehouse import cluster_by_week
from upcharts.session import list_folder, materialise
from upcharts.sources import history as loads


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def by_hash(plan: str) -> int:
    return len(re.findall(r"Exchange hashpartitioning", plan))


def test_bulk_flags_do_not_shuffle_the_entries(spark, make_history):
    data = [(0, i, f"t{i}", {"artist": "A" if i < 6 else "B", **DEBUT}) for i in range(1, 9)]
    flagged = staging.flag_bulk_entries(make_history(data).drop("is_release_week_bulk_entry"))
    assert by_hash(final_plan(flagged)) == 0
    assert {r.rank for r in flagged.where("is_release_week_bulk_entry").collect()} == {1, 2, 3, 4, 5}


def test_running_minimum_takes_one_shuffle_by_song(spark, make_history):
    data = [(0, 9, "a", DEBUT), (0, 8, "a", {}), (1, 5, "a"), (8, 4, "a"), (9, 1, "a"), (2, 7, "b", DEBUT), (2, 7, "b", DEBUT), (3, 8, "b"), (20, 9, "c")]
    h = make_history(data)
    best = cohort.best_rank(h, strategy="window")
    # by song, and by the keys of the result, whose rows are one per debut
    assert by_hash(final_plan(best)) <= 2
    assert rows(best) == rows(cohort.best_rank(h))


def test_exported_json_is_compressed(spark, make_history, tmp_path):
    h = make_history([(0, 1, "a"), (1, 2, None)])
    loads.export_ndjson(h, str(tmp_path / "out"))
    files = [n for n in list_folder(spark, str(tmp_path / "out")) if n.startswith("part-")]
    assert files and all(n.endswith(".json.gz") for n in files)
    assert rows(loads.read_ndjson(spark, str(tmp_path / "out"))) == rows(h)


def test_an_applied_gated_load_is_not_judged_again(spark, make_history, tmp_path, monkeypatch):
    h = make_history([(0, 1, "a"), (0, 1, "b"), (1, 1, "c")])
    paths = str(tmp_path / "history"), str(tmp_path / "quarantine")
    assert loads.load_gated(h, *paths, "once").rows == 1
    monkeypatch.setattr(quality, "with_reasons", lambda *_, **__: pytest.fail("judged again"))
    assert loads.load_gated(h, *paths, "once") is None


def test_stored_weeks_keep_a_credit_together(spark, make_history):
    data = [(w, i + 1, f"t{i}", {"artist": f"A{i % 7}"}) for w in range(4) for i in range(60)]
    stored = materialise(cluster_by_week(make_history(data)), "clustered")
    files = stored.groupBy(F.input_file_name()).agg(F.collect_list(F.struct("chart_date", "artist", "title")).alias("r"))
    for (found,) in files.select("r").collect():
        keys = [tuple(r) for r in found]
        assert keys == sorted(keys)
    assert rows(stored) == rows(make_history(data))


def test_buckets_follow_the_rows(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(registry, "ROWS_PER_BUCKET", 300)
    stored = registry._by_song(spark, sf_dir)
    count = stored.count()
    assert count > 8 * 300 and f"SelectedBucketsCount: {-(-count // 300)} out of" in stored.groupBy("title", "artist").count()._jdf.queryExecution().executedPlan().toString()


def sales_tables(spark, folder):
    """Lineitem and part: 2,000 lines of 40 parts."""
    part = spark.range(1, 41).select(
        F.col("id").alias("p_partkey"),
        F.concat(F.lit("red "), F.when(F.col("id") % 2 == 0, "ring").otherwise("cap")).alias("p_name"),
        F.when(F.col("id") % 3 == 0, "PROMO").otherwise("STANDARD").alias("p_type"),
        F.concat(F.lit("Brand#1"), (F.col("id") % 5).cast("string")).alias("p_brand"),
        (F.col("id") % 50).cast("int").alias("p_size"),
    )
    lines = spark.range(2000).select(
        (F.col("id") * 7 % 40 + 1).alias("l_partkey"),
        (F.col("id") % 13).cast("double").alias("l_quantity"),
        F.date_add(F.lit("1996-01-01").cast("date"), (F.col("id") % 700).cast("int")).cast("timestamp").alias("l_shipdate"),
    )
    part.write.parquet(f"{folder}/part.parquet")
    lines.write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def test_tasks_of_the_warehouse_follow_the_rows(spark, tmp_path, monkeypatch):
    folder, shuffles, store = sales_tables(spark, tmp_path), [], materialise

    def planned(df, name):
        text = df._jdf.queryExecution().executedPlan().toString()
        shuffles.extend(int(n) for n in re.findall(r"Exchange hashpartitioning\([^\n]*?, (\d+)\)", text))
        return store(df, name)

    keys = "spark.sql.shuffle.partitions", "spark.sql.files.minPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    settings = [spark.conf.get(k, None) for k in keys]
    plain = warehouse.build_warehouse(spark, folder)
    monkeypatch.setattr(session, "ROWS_PER_TASK", 100)
    for module in (warehouse, staging):
        monkeypatch.setattr(module, "materialise", planned)
    built = warehouse.build_warehouse(spark, folder)
    assert shuffles and set(shuffles) == {20}
    assert [spark.conf.get(k, None) for k in keys] == settings
    for stored in ("entries", "metadata", "history", "debuts"):
        assert rows(getattr(built, stored)) == rows(getattr(plain, stored))
    assert built.cutoff == plain.cutoff


def test_sized_jobs_keep_larger_settings(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "5MB")
    try:
        with session.sized_for(spark, 3 * session.ROWS_PER_TASK):
            assert spark.conf.get("spark.sql.shuffle.partitions") == "8" and spark.conf.get(key) == "5MB"
        assert spark.conf.get(key) == "5MB"
    finally:
        spark.conf.unset(key)


def test_name_scores_shuffle_packed_blocks(spark, monkeypatch):
    """What meets is a row for each block and other block, a few bytes a text, not a row for each text."""
    monkeypatch.setattr(matching, "NAME_BLOCK", 1000)
    monkeypatch.setattr(matching, "CANDIDATE_BLOCK", 500)
    met, compared = [], DataFrame.mapInArrow
    monkeypatch.setattr(DataFrame, "mapInArrow", lambda df, *a, **k: (met.append(df), compared(df, *a, **k))[1])
    names = spark.range(2000).select(F.concat(F.lit("an act "), "id").alias("name"))
    got = matching.name_scores(names, names.withColumnRenamed("name", "candidate"), 90)
    assert by_hash(final_plan(got)) == 0
    assert met[-1].count() == 2 * 2 * 4 and 10 * met[-1].agg(F.max(F.length("data"))).first()[0] < 1000 * 200
    assert got.select("name").distinct().count() == 2000


def test_name_scores_write_names_together(spark, monkeypatch):
    """A task has a bounded number of texts and returns them name by name, so that files hold each once."""
    monkeypatch.setattr(matching, "BLOCK_CHARACTERS", 1000)
    names = spark.range(200).select(F.concat(F.lit("one act with a long name "), "id").alias("name"))
    got = matching.name_scores(names, names.withColumnRenamed("name", "candidate"), 50)
    tasks: dict[int, list] = {}
    for r in got.withColumn("task", F.spark_partition_id()).collect():
        tasks.setdefault(r.task, []).append((r.name, r.candidate))
    assert sum(map(len, tasks.values())) == 200 * 200
    for pairs in tasks.values():
        changes = 1 + sum(a[0] != b[0] for a, b in zip(pairs, pairs[1:]))
        assert changes == len({n for n, _ in pairs})
        for side in zip(*pairs):
            assert sum(map(len, set(side))) < 2500
