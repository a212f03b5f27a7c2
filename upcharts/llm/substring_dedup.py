"""Removal of long passages that repeat, over a compacted de Bruijn graph of words.

The graph's edges are the windows of 35 consecutive words (k-mers of tokens), each
joining its first 34 words to its last 34. Edges are never shuffled one by one:

1. Every window picks the smallest hashed run of ``SEED`` words inside it. Successive
   windows that pick the same run form one path piece, at most 30 edges long, which
   is one row: (seed, path, document, first edge, edges). Equal windows pick equal
   seeds, so only pieces with the same seed can share an edge.
2. Pieces are counted by seed. A seed seen once is dropped. If all pieces of a seed
   are the same path, the path does not branch there: all its edges repeat, and the
   piece stays compact. A join on the seed brings this back to the pieces.
3. Where the pieces of a seed differ, the graph branches. A path that occurs twice still
   repeats as a whole. One piece of each path at a branch is taken apart: its windows are
   hashed from the text and counted, and those of paths seen once are joined back.
4. Source coordinates, grouped by document, say which words the repeated edges cover.

A window is known by two 64-bit hashes of its words (seed and path in steps 2,
two window hashes in step 3), 128 bits in all. Counts combine before each shuffle, and
the joins back to pieces and windows are plain sort-merge joins, which AQE may split.

Words are maximal runs of bytes outside space and 09-0D, unchanged. A null text has no
words; texts under 35 words lose nothing. Rows that repeat doc_id and text count as
documents of their own, so both lose what they share. Other columns are ignored. An
empty table gives an empty result.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upcharts.llm.ship import in_tasks
from upcharts.llm.text import mix, row_key, run_hashes, signed, text_slices, words_of
from upcharts.session import materialise

WINDOW = 35
SEED = 6

_POS = (1 << 22) - 1


def _pieces(hashes: np.ndarray, bounds: np.ndarray, room: np.ndarray, window: int, seed: int):
    """Path pieces: seed hash, path hash, first window, number of windows (word indices)."""
    runs = run_hashes(hashes, seed)
    span = window - seed + 1
    # the position fills the low bits, so that the rightmost of equal runs is picked
    place = np.arange(len(runs), dtype=np.uint64)
    key = (runs & np.uint64(~_POS & (1 << 64) - 1)) | (np.uint64(_POS) - (place & np.uint64(_POS)))
    width = 1
    while width * 2 <= span:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    if width < span:
        extra = span - width
        key = np.minimum(key[: len(key) - extra], key[extra:])
    starts = np.flatnonzero(room[: len(key)])
    if not len(starts):
        return None
    key = key[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (key[1:] != key[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    a, b = starts[first], starts[last]
    # recover the picked run from its low position bits; it lies within the window
    low = (np.uint64(_POS) - (key[first] & np.uint64(_POS))).astype(np.int64)
    at = a + ((low - a) & _POS)
    whole = run_hashes(hashes, window)
    count = b - a + 1
    path = mix(whole[a] * np.uint64(0xA24BAED4963EE407) + mix(whole[b] + count.astype(np.uint64)) + (at - a).astype(np.uint64))
    return runs[at], path, a, count


def _text_pieces(window: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in text_slices(batch.column("text")):
                words = words_of(data, offsets)
                if len(words.hashes) < window:
                    continue
                found = _pieces(words.hashes, words.bounds, words.room(window), window, seed)
                if found is None:
                    continue
                runs, path, a, count = found
                doc = np.searchsorted(words.bounds, a, "right") - 1
                yield pa.record_batch(
                    {
                        "seed": signed(runs),
                        "path": signed(path),
                        "_id": batch.column("_id").take(pa.array(row + doc)),
                        "_check": batch.column("_check").take(pa.array(row + doc)),
                        "start": pa.array((a - words.bounds[doc]).astype(np.int32)),
                        "edges": pa.array(count.astype(np.int16)),
                    }
                )

    return run


def _text_windows(window: int):
    """Hashes of the windows of pieces to take apart; ``spans`` holds (start, edges, sure, apart)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column("spans")
            for row, end, data, offsets in text_slices(batch.column("text")):
                words = words_of(data, offsets)
                one, two = run_hashes(words.hashes, window, 1), run_hashes(words.hashes, window, 2)
                part = spans.slice(row, end - row)
                flat = part.flatten()
                doc = np.repeat(np.arange(end - row), part.value_lengths().to_numpy(zero_copy_only=False))
                start = flat.field("start").to_numpy()
                edges = flat.field("edges").to_numpy().astype(np.int64)
                sure = flat.field("sure").to_numpy(zero_copy_only=False)
                which = flat.field("apart").to_numpy(zero_copy_only=False)
                doc, start, edges, sure = doc[which], start[which].astype(np.int64), edges[which], sure[which]
                total = int(edges.sum())
                if not total:
                    continue
                inner = np.arange(total) - np.repeat(np.cumsum(edges) - edges, edges)
                start = np.repeat(start, edges) + inner
                doc = np.repeat(doc, edges)
                at = words.bounds[doc] + start
                yield pa.record_batch(
                    {
                        "one": signed(one[at]),
                        "two": signed(two[at]),
                        "_id": batch.column("_id").take(pa.array(row + doc)),
                        "_check": batch.column("_check").take(pa.array(row + doc)),
                        "start": pa.array(start.astype(np.int32)),
                        "sure": pa.array(np.repeat(sure, edges)),
                    }
                )

    return run


def _kept_texts(window: int, with_text: bool):
    """Apply the covered words of each text: counts, digest, and the kept text if wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, singles = batch.column("spans"), batch.column("singles")
            for row, end, data, offsets in text_slices(batch.column("text")):
                words = words_of(data, offsets)
                base = data[int(offsets[0]) : int(offsets[-1])]
                depth = np.zeros(len(words.hashes) + 1, np.int64)
                for column, whole in ((spans, True), (singles, False)):
                    part = column.slice(row, end - row)
                    lengths = part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                    doc = np.repeat(np.arange(end - row), lengths)
                    flat = part.flatten()
                    if whole:
                        start = flat.field("start").to_numpy().astype(np.int64)
                        edges = flat.field("edges").to_numpy().astype(np.int64)
                        sure = flat.field("sure").to_numpy(zero_copy_only=False)
                        doc, start, edges = doc[sure], start[sure], edges[sure]
                    else:
                        start, edges = flat.to_numpy().astype(np.int64), 1
                    at = words.bounds[doc] + start
                    np.add.at(depth, at, 1)
                    np.add.at(depth, at + edges + window - 1, -1)
                gone = np.cumsum(depth[:-1]) > 0
                removed = np.add.reduceat(np.append(gone, False).astype(np.int64), words.bounds[:-1])
                removed[np.diff(words.bounds) == 0] = 0
                texts = _joined(base, words, ~gone)
                out = {
                    "doc_id": batch.column("doc_id").slice(row, end - row),
                    "n_words": pa.array(np.diff(words.bounds)),
                    "n_removed": pa.array(removed),
                    "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
                }
                if with_text:
                    out["kept_text"] = pa.array([t.decode() for t in texts])
                yield pa.record_batch(out)

    return run


def _joined(base: np.ndarray, words, keep: np.ndarray) -> list[bytes]:
    """The kept words of each text, joined by one space."""
    starts, ends = words.starts[keep], words.ends[keep]
    bounds = np.concatenate([[0], np.cumsum(keep)])[words.bounds]
    # copy each word with a space behind it into one buffer
    lengths = ends - starts + 1
    goal = np.concatenate([[0], np.cumsum(lengths)])
    out = np.full(int(goal[-1]), 0x20, np.uint8)
    inside = np.zeros(len(base) + 1, np.int8)
    np.add.at(inside, starts, 1)
    np.add.at(inside, ends, -1)
    taken = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    spot = np.ones(len(out), bool)
    spot[goal[1:] - 1] = False
    out[spot] = base[taken]
    raw = out.tobytes()
    edges = goal[bounds]
    return [raw[a : b - 1] if b > a else b"" for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]


_PIECE = "seed long, path long, _id long, _check long, start int, edges short"


def repeated_pieces(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document with repeated seeds: its pieces as (start, edges, sure, apart).

    All edges of a ``sure`` piece repeat. Pieces ``apart`` have to be taken apart: the
    unsure ones, and one piece of each sure path they may share edges with.
    """
    seed = min(SEED, window)
    texts = docs.select(*row_key(), "text")
    pieces = materialise(in_tasks(texts, _text_pieces(window, seed), _PIECE), "path_pieces")
    # stored, so that the join below reads two plain shuffles and AQE can split a hot seed
    seeds = materialise(
        pieces.groupBy("seed")
        .agg(F.count("*").alias("n"), F.min("path").alias("low"), F.max("path").alias("high"))
        .where("n > 1")
        .select("seed", (F.col("low") != F.col("high")).alias("branches")),
        "repeated_seeds",
    )
    repeated = materialise(pieces.join(seeds, "seed"), "repeated_pieces")
    place = F.struct("_id", "_check", "start")
    path = ["seed", "path"]
    paths = repeated.where("branches").groupBy(*path).agg(F.count("*").alias("n"), F.min(place).alias("one_place"))
    known = repeated.join(paths, path, "left")
    span = F.struct(
        "start",
        "edges",
        (~F.col("branches") | (F.col("n") > 1)).alias("sure"),
        (F.col("branches") & (place == F.col("one_place"))).alias("apart"),
    )
    return materialise(known.groupBy("_id", "_check").agg(F.collect_set(span).alias("spans")), "path_spans")


def remove_repeats(docs: DataFrame, window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 (and kept_text)."""
    spans = repeated_pieces(docs, window)
    texts = docs.select("doc_id", *row_key(), "text")
    key = ["_id", "_check"]

    branching = spans.where(F.exists("spans", lambda s: s["apart"]))
    # rows that repeat doc_id and text hold the same pieces, which are compared once
    taken_apart = texts.join(branching, key).select(*key, "text", "spans").dropDuplicates(key)
    schema = "one long, two long, _id long, _check long, start int, sure boolean"
    windows = materialise(in_tasks(taken_apart, _text_windows(window), schema), "branch_windows")
    twice = windows.groupBy("one", "two").agg(F.count("*").alias("n")).where("n > 1").select("one", "two")
    unsure = windows.where("not sure").drop("sure")
    singles = unsure.join(twice, ["one", "two"]).groupBy(*key).agg(F.collect_set("start").alias("singles"))

    covered = texts.join(spans, key, "left").join(singles, key, "left")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if with_text else "")
    return in_tasks(covered.select("doc_id", "text", "spans", "singles"), _kept_texts(window, with_text), schema)
