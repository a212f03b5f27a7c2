"""Registered queries of the numbered operators, and their DuckDB statements."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from upcharts.llm import (
    conversations,
    decontamination,
    exact_dedup,
    language_id,
    line_dedup,
    near_dedup,
    oracles,
    packing,
    parity_join,
    sharding,
    spelling,
    substring_dedup,
    token_files,
    toxicity,
)
from upcharts.session import fresh_path, table_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, "documents"))


@query
def op1_line_dedup(spark, sf_dir):
    return line_dedup.line_report(_documents(spark, sf_dir))


@query
def op2_token_files(spark, sf_dir):
    folder = fresh_path(spark, "token_files")
    token_files.write_tokens(_documents(spark, sf_dir), folder)
    return token_files.token_digests(spark, folder)


@query
def op3_exact_dedup(spark, sf_dir):
    return exact_dedup.dedup_against(_documents(spark, sf_dir), fresh_path(spark, "digest_index"))


@query
def op4_sharding(spark, sf_dir):
    return sharding.add_law(sharding.shard_by_bytes(_documents(spark, sf_dir)))


@query
def op5_language_id(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    return language_id.identify(docs, language_id.train(docs))


@query
def op6_toxicity(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    labels = spark.read.parquet(table_path(sf_dir, "labels"))
    return toxicity.score(docs, toxicity.train(docs, labels))


@query
def op7_substring_dedup(spark, sf_dir):
    return substring_dedup.remove_repeats(_documents(spark, sf_dir))


@query
def op8_near_dedup(spark, sf_dir):
    return near_dedup.near_groups(_documents(spark, sf_dir), shingle=4)


@query
def op9_decontamination(spark, sf_dir):
    benchmark = spark.read.parquet(table_path(sf_dir, "benchmark"))
    return decontamination.find_leaks(_documents(spark, sf_dir), benchmark)


@query
def op10_packing(spark, sf_dir):
    return packing.pack_documents(_documents(spark, sf_dir))


@query
def op11_conversation_repair(spark, sf_dir):
    return conversations.repair_report(spark.read.parquet(table_path(sf_dir, "conversations")))


@query
def op12_ngram_join(spark, sf_dir):
    return parity_join.ngram_join(_documents(spark, sf_dir))


@query
def op13_spelling_variants(spark, sf_dir):
    found = spelling.misspelt(spelling.runs(_documents(spark, sf_dir)))
    return spelling.spelling_variants(spelling.word_counts(found))


ORACLE: dict[str, str] = {
    "op1_line_dedup": """
        WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS body FROM documents),
        l AS (
          SELECT doc_id, i - 1 AS line_no, body[i] AS line
          FROM (SELECT doc_id, body, unnest(range(1, len(body) + 1)) AS i FROM d WHERE text IS NOT NULL)
          WHERE trim(body[i], ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> ''
        ),
        u AS (
          SELECT line, min({'doc_id': doc_id, 'line_no': line_no}) AS first, string_split(line, ' ') AS w
          FROM l GROUP BY line
        ),
        k AS (SELECT *, len(w) AS n, unnest(list_distinct([len(w) // 2, (len(w) - 1) // 2])) AS half FROM u WHERE len(w) >= 3),
        p AS (
          SELECT a.line, b.line AS other, a.w, a.n, b.w AS v, b.n AS m, b.first AS near
          FROM k a JOIN k b ON a.half = b.half AND a.w[1:a.half] = b.w[1:b.half]
          WHERE b.first < a.first AND abs(a.n - b.n) <= 1 AND greatest(a.n, b.n) >= 4
          UNION
          SELECT a.line, b.line, a.w, a.n, b.w, b.n, b.first
          FROM k a JOIN k b ON a.half = b.half AND a.w[a.n - a.half + 1:] = b.w[b.n - b.half + 1:]
          WHERE b.first < a.first AND abs(a.n - b.n) <= 1 AND greatest(a.n, b.n) >= 4
        ),
        near AS (
          SELECT line, min(near) AS near FROM p
          WHERE CASE
            WHEN n = m THEN len(list_filter(range(1, n + 1), lambda i: w[i] <> v[i])) = 1
            WHEN n > m THEN len(list_filter(range(1, n + 1), lambda i: list_concat(w[1:i - 1], w[i + 1:]) = v)) > 0
            ELSE len(list_filter(range(1, m + 1), lambda i: list_concat(v[1:i - 1], v[i + 1:]) = w)) > 0
          END
          GROUP BY line
        ),
        gone AS (
          SELECT l.doc_id, l.line_no, coalesce(near.near, u.first) AS keep
          FROM l JOIN u USING (line) LEFT JOIN near USING (line)
          WHERE coalesce(near.near, u.first) <> {'doc_id': l.doc_id, 'line_no': l.line_no}
        ),
        r AS (
          SELECT doc_id, count(*) AS n_removed, string_agg(line_no::VARCHAR, ',' ORDER BY line_no) AS removed_lines,
            string_agg(keep.doc_id::VARCHAR, ',' ORDER BY line_no) AS kept_from
          FROM gone GROUP BY doc_id
        )
        SELECT d.doc_id, coalesce(len(d.body), 0)::INTEGER AS n_lines, coalesce(r.n_removed, 0)::INTEGER AS n_removed,
          coalesce(r.removed_lines, '') AS removed_lines, coalesce(r.kept_from, '') AS kept_from
        FROM d LEFT JOIN r USING (doc_id)
    """,
    "op3_exact_dedup": """
        WITH d AS (
          SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
          FROM documents
        ), g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY body)
        SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(body) AS text_sha256
        FROM d JOIN g USING (body)
    """,
    "op7_substring_dedup": oracles.REPEATS,
    "op8_near_dedup": oracles.similar(4, 80, ", s.doc_id = component_id AS kept"),
    "op11_conversation_repair": oracles.REPAIR,
    "op12_ngram_join": oracles.similar(3, 90),
    "op13_spelling_variants": oracles.SPELLING,
}
