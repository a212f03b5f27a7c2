"""Resolve chart credits to artists through a table of lookup answers.

Candidates: ``name, artist_id, score, tags, error`` -- zero or more rows per
looked-up name; a row with ``error`` is a lookup that failed.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upcharts.functions.credits import primary_artist
from upcharts.functions.tags import no_tags
from upcharts.schemas import ARTIST_METADATA
from upcharts.session import materialise

SCORE_THRESHOLD = 80

METADATA_COLUMNS = ARTIST_METADATA.fieldNames()


def unique_credits(entries: DataFrame) -> DataFrame:
    return entries.select("artist").distinct()


def credit_map(credits: DataFrame) -> DataFrame:
    """Credit -> lead artist."""
    return credits.select("artist", primary_artist("artist").alias("primary_artist_used"))


def best_candidate(candidates: DataFrame) -> DataFrame:
    """The single best answer per name; answers without error come first.

    min over a struct combines on the map side, so a name with very many
    candidates is not sorted in one task.
    """
    score = F.coalesce(F.expr("try_cast(score AS int)"), F.lit(0))
    order = F.struct(
        F.col("error").isNotNull().alias("failed"),
        (-score).alias("negated_score"),
        "artist_id",
        "tags",
        "error",
    )
    return (
        candidates.groupBy("name")
        .agg(F.min(order).alias("best"))
        .select(
            F.col("name").alias("primary_artist_used"),
            F.col("best.artist_id").alias("artist_id"),
            (-F.col("best.negated_score")).alias("score"),
            F.col("best.tags").alias("tags"),
            F.col("best.error").alias("error"),
        )
    )


#: most names and candidates of one block, and characters of either; one task compares two blocks
NAME_BLOCK, CANDIDATE_BLOCK, BLOCK_CHARACTERS = 32_768, 32_768, 1 << 20
#: a block is not made smaller than this to give every core one
LEAST_BLOCK = 1_024
#: bytes of a task for common grams, and pairs it returns at once
DENSE_BYTES, PAIRS_AT_ONCE = 64 << 20, 1 << 17


def _closed(name: Column, q: int) -> Column:
    """A name in lower case between marks, whose q-grams are compared."""
    return F.concat(F.lit(" " * (q - 1)), F.lower(F.trim(name)), F.lit(" " * (q - 1)))


def _grams(name: Column, q: int) -> Column:
    """Distinct q-grams of a name in lower case between marks."""
    closed = _closed(name, q)
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(closed) - (q - 1)), lambda i: F.substring(closed, i, F.lit(q))))


def _block_index(q: int) -> Callable:
    """Function for the rows of one block (block, closed, text): one row (block, data) with its texts and their grams.

    ``data`` is a compressed Arrow stream of ``text`` and ``grams``, places in the list of the block's distinct
    grams. Texts are in order and their grams as they follow each other, so that neighbours are alike.
    """

    def index(batches):
        import pyarrow as pa

        columns = [[x for part in parts for x in part] for parts in zip(*([c.to_pylist() for c in b.columns] for b in batches))]
        if not columns or not columns[0]:
            return
        places: dict[str, int] = {}
        ends, held, texts = [0], [], []
        for closed, text in sorted(zip(*columns[1:])):
            grams = dict.fromkeys(closed[i : i + q] for i in range(len(closed) - q + 1)) or {"": None}
            held.extend(places.setdefault(g, len(places)) for g in grams)
            ends.append(len(held))
            texts.append(text)
        grams = pa.DictionaryArray.from_arrays(pa.array(held, pa.int32()), pa.array(list(places), pa.string()))
        rows = pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), grams)], names=["text", "grams"])
        with pa.ipc.new_stream(sink := pa.BufferOutputStream(), rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
            stream.write_batch(rows)
        data = pa.array([sink.getvalue().to_pybytes()], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(columns[0][:1], pa.int32()), data], names=["block", "data"])

    return index


def _block_scores(threshold: int) -> Callable:
    """Function for rows (pair, is_name, data), a block of names and one of candidates a pair: their texts that reach the threshold.

    Each name counts the grams it shares with all candidates of the block at once. Common grams are
    rows of 0 and 1 over the candidates, as many as ``DENSE_BYTES`` hold, the others lists of their
    candidates. A name is left out before that where the block holds too few of its grams: m grams
    need a partner that shares t m / (200 - t) at least.
    """
    dense_bytes, at_once = DENSE_BYTES, PAIRS_AT_ONCE

    def compare(batches):
        import numpy as np
        import pyarrow as pa

        def side(data):
            rows = pa.ipc.open_stream(data).read_next_batch()
            grams = rows.column("grams")
            sizes = np.diff(grams.offsets.to_numpy()).astype(np.int64)
            return rows.column("text"), grams.values.dictionary.to_pylist(), sizes, grams.values.indices.to_numpy()

        def met(names, name_grams, name_sizes, name_held, candidates, grams, sizes, held):
            n = len(sizes)
            counts = np.bincount(held, minlength=len(grams))
            ends = counts.cumsum()
            owners = np.repeat(np.arange(n), sizes)[np.argsort(held, kind="stable")]
            holders = [owners[end - count : end] for count, end in zip(counts.tolist(), ends.tolist())]
            common = [g for g in np.argsort(-counts, kind="stable")[: dense_bytes // n].tolist() if 256 * counts[g] > n]
            dense = dict(zip(common, np.zeros((len(common), n), np.uint8)))
            for gram, marks in dense.items():
                marks[holders[gram]] = 1

            place = {g: i for i, g in enumerate(grams)}
            known = np.array([place.get(g, -1) for g in name_grams])[name_held]
            first = np.concatenate([[0], name_sizes.cumsum()])
            found = np.add.reduceat((known >= 0).astype(np.int64), first[:-1])
            needs: dict[int, np.ndarray] = {}
            pending, waiting = [], 0

            def pairs():
                left = np.repeat([at for at, _, _ in pending], [len(hits) for _, hits, _ in pending])
                right, shared = (np.concatenate([x[i] for x in pending]) for i in (1, 2))
                scores = 200 * shared.astype(np.int64) // (name_sizes[left] + sizes[right])
                columns = [names.take(pa.array(left)), candidates.take(pa.array(right)), pa.array(scores.astype(np.int32))]
                return pa.RecordBatch.from_arrays(columns, names=["name", "candidate", "score"])

            for at in np.flatnonzero((found > 0) & (found * (200 - threshold) >= threshold * name_sizes)).tolist():
                size = int(name_sizes[at])
                if size not in needs:
                    if len(needs) * n > dense_bytes:
                        needs.clear()
                    # no more than the name has are shared, so one above that is never reached
                    least = np.clip(-(-threshold * (sizes + size) // 200), 1, size + 1)
                    needs[size] = least.astype(np.uint8 if size < 255 else np.uint16 if size < 65535 else np.uint32)
                need = needs[size]
                shared = np.zeros(n, need.dtype)
                for gram in known[first[at] : first[at + 1]].tolist():
                    if gram in dense:
                        np.add(shared, dense[gram], out=shared)
                    elif gram >= 0:
                        shared[holders[gram]] += 1
                hits = np.flatnonzero(shared >= need)
                if len(hits):
                    pending.append((at, hits, shared[hits]))
                    waiting += len(hits)
                    if waiting >= at_once:
                        yield pairs()
                        pending, waiting = [], 0
            if pending:
                yield pairs()

        waiting_sides = {}
        for batch in batches:
            for pair, is_name, data in zip(*(batch.column(c) for c in ("pair", "is_name", "data"))):
                other = waiting_sides.pop(pair.as_py(), None)
                if other is None:
                    waiting_sides[pair.as_py()] = data.as_buffer()
                    continue
                both = (data.as_buffer(), other) if is_name.as_py() else (other, data.as_buffer())
                yield from met(*side(both[0]), *side(both[1]))

    return compare


def name_scores(names: DataFrame, catalogue: DataFrame, threshold: int = SCORE_THRESHOLD, q: int = 3) -> DataFrame:
    """Candidates of each ``names.name`` among ``catalogue.candidate``: name, candidate, score.

    The score is 100 times Dice's coefficient of the names' distinct q-grams, rounded down.
    Both sides are dealt into blocks of bounded size, each packed into one row with its grams, and every
    two blocks meet in a task, which counts the shared grams of all its pairs; only pairs that
    reach the threshold leave it, a batch at a time. Packed blocks are copied for each block of the other
    side, about twenty bytes a text. The work is quadratic, at two nanoseconds a pair or so, and as many rows
    come out as names are alike. Null names have no candidates.
    """
    spark = names.sparkSession
    tasks = 2 * spark.sparkContext.defaultParallelism

    def side(rows: DataFrame, column: str) -> tuple[DataFrame, int, int]:
        """Distinct texts, their number and the least number of blocks for them."""
        texts = rows.where(F.col(column).isNotNull()).select(column).distinct()
        texts = materialise(texts.select(_closed(F.col(column), q).alias("closed"), F.col(column).alias("text")), f"{column}_texts")
        count, characters = texts.agg(F.count("*"), F.coalesce(F.sum(F.length("closed")), F.lit(0))).first()
        most = NAME_BLOCK if column == "name" else CANDIDATE_BLOCK
        return texts, count, max(1, -(-count // most), -(-characters // BLOCK_CHARACTERS))

    def blocks(texts: DataFrame, number: int) -> DataFrame:
        block = F.pmod(F.xxhash64("text"), F.lit(number)).cast("int").alias("block")
        dealt = texts.select(block, "closed", "text").repartitionById(number, "block")
        return dealt.mapInArrow(_block_index(q), "block int, data binary")

    def every(number: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(number - 1)))

    left, count, name_blocks = side(names, "name")
    right, _, candidate_blocks = side(catalogue, "candidate")
    name_blocks = max(name_blocks, min(-(-tasks // candidate_blocks), -(-count // LEAST_BLOCK)))
    pair = (F.col("name_block") * candidate_blocks + F.col("candidate_block")).alias("pair")
    asked = blocks(left, name_blocks).withColumnRenamed("block", "name_block").withColumn("candidate_block", every(candidate_blocks))
    held = blocks(right, candidate_blocks).withColumnRenamed("block", "candidate_block").withColumn("name_block", every(name_blocks))
    sides = [rows.select(pair, F.lit(is_name).alias("is_name"), "data") for rows, is_name in ((asked, True), (held, False))]
    met = sides[0].union(sides[1]).repartitionById(name_blocks * candidate_blocks, "pair")
    return met.mapInArrow(_block_scores(threshold), "name string, candidate string, score int")


def equal_names(names: DataFrame, catalogue: DataFrame, q: int = 3) -> DataFrame:
    """Pairs of a name and a candidate with the same grams, whose score is 100: name, candidate, score."""

    def side(rows: DataFrame, column: str) -> DataFrame:
        # stored, or Catalyst would ask for the grams of every row before the distinct
        texts = materialise(rows.where(F.col(column).isNotNull()).select(column).distinct(), f"{column}_texts")
        return texts.withColumn("grams", F.array_sort(_grams(F.col(column), q)))

    return side(names, "name").join(side(catalogue, "candidate"), "grams").select("name", "candidate", F.lit(100).alias("score"))


def scored_candidates(names: DataFrame, catalogue: DataFrame, threshold: int = SCORE_THRESHOLD, best_only: bool = False) -> DataFrame:
    """Lookup answers for ``names`` (name) from a ``catalogue`` (candidate, artist_id, tags), scored by name.

    ``best_only`` leaves out answers that cannot be a name's best: where a candidate has the
    same grams, which is the highest score, the others are not searched for.
    """
    if best_only and threshold <= 100:
        equal = materialise(equal_names(names, catalogue), "equal_names")
        rest = names.join(equal.select("name").distinct(), "name", "left_anti")
        found = equal.union(name_scores(rest, catalogue, threshold))
    else:
        found = name_scores(names, catalogue, threshold)
    error = F.lit(None).cast("string").alias("error")
    return found.join(catalogue, "candidate").select("name", "artist_id", "score", "tags", error)


def match_artists(names: DataFrame, candidates: DataFrame, threshold: int = SCORE_THRESHOLD) -> DataFrame:
    """``names`` (any rows with primary_artist_used) plus status, score, mbid, tags, found, error.

    The best answer is taken first and must then reach ``threshold``. A failed
    lookup stays apart from a name that truly has no match.
    """
    found = F.coalesce(F.col("score") >= threshold, F.lit(False)) & F.col("error").isNull()
    status = F.when(F.col("error").isNotNull(), "failed").when(found, "matched").otherwise("unmatched")
    return names.join(best_candidate(candidates), "primary_artist_used", "left").select(
        *names.columns,
        status.alias("status"),
        "score",
        F.when(found, F.col("artist_id")).alias("mbid"),
        F.when(found, F.coalesce("tags", no_tags())).otherwise(no_tags()).alias("tags"),
        found.alias("found"),
        "error",
    )


def fan_out(credits: DataFrame, results: DataFrame) -> DataFrame:
    """Match results keyed by every original credit (the artist metadata table)."""
    return credits.join(results, "primary_artist_used").select(*METADATA_COLUMNS)


def match_status(results: DataFrame) -> DataFrame:
    """Lead artists per outcome."""
    return results.groupBy("status").agg(F.count("*").alias("primaries"))


def lookup_artists(entries: DataFrame, candidates: DataFrame, threshold: int = SCORE_THRESHOLD) -> DataFrame:
    """Artist metadata for all credits of the chart.

    Answers are reduced to one per name before the join, so each lead artist is
    resolved once; joining them to the distinct credits directly makes the
    separate fan-out step unnecessary, and the credit is parsed once per credit.
    """
    credits = credit_map(unique_credits(entries))
    return match_artists(credits, candidates, threshold).select(*METADATA_COLUMNS)


def match_summary(entries: DataFrame, metadata: DataFrame) -> DataFrame:
    """One row: lead artists, credits, weeks, credits found (of all credits); each table is scanned once."""
    # an unknown lead artist counts as one
    unknown = F.coalesce(F.max(F.col("primary_artist_used").isNull().cast("int")), F.lit(0))
    return metadata.agg(
        (F.count_distinct("primary_artist_used") + unknown).alias("unique_primaries"),
        F.count("*").alias("credits"),
        F.count_if("found").alias("credits_found"),
    ).select(
        "unique_primaries",
        "credits",
        entries.select(F.count_distinct("chart_date")).scalar().alias("weeks"),
        "credits_found",
    )
