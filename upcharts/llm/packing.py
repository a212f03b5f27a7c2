"""Best-fit packing of token pieces into sequences by exact-complement hashing.

Packing depends on lengths only, and there are at most 4,096 of them, so the plan is
made from a histogram, whose size does not grow with the data. Longest first, a length
is completed by pieces that fill its gap exactly: an index of available lengths, their
pair sums and their triple sums is asked for the gap, and the combination is consumed as
often as the availability counts allow. If there is none, the gap is filled best-fit:
the longest available piece that fits, again and again. Each step serves many sequences
at once, so the plan is a short list of runs.

A piece finds its run by its rank among the pieces of its length, in the order of
doc_id and piece. Ranks are global positions from per-block totals, so a length that a
third of all pieces share is still spread over blocks.

Documents over the capacity are cut into full pieces and a rest; each begins at its own
offset. Null texts hold the end id only, so every document has a piece. Rows that are
equal in doc_id, piece and ids may trade places; null doc_ids come first. Other columns
are ignored. An empty table gives an empty result.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upcharts.llm.positions import in_blocks, running_sums
from upcharts.llm.ship import in_tasks
from upcharts.llm.text import text_slices
from upcharts.llm.tokens import END, SLICE, VOCABULARY, encoder
from upcharts.session import materialise

CAPACITY = 4096


class _Available:
    """Counts of the lengths still to be placed, asked for exact and best fits."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts.copy()

    def has(self, lengths: list[int]) -> bool:
        return all(self.counts[x] >= lengths.count(x) for x in lengths)

    def exact(self, gap: int, used: list[int]) -> list[int] | None:
        """One, two or three lengths that fill ``gap`` exactly beside ``used``."""
        if self.has([*used, gap]):
            return [gap]
        there = np.flatnonzero(self.counts[:gap] > 0)
        # pairs: a length and its complement, as near to each other as there are
        other = gap - there
        low = there[(other <= there) & (self.counts[other] > 0)]
        for a in low.tolist():
            if self.has([*used, a, gap - a]):
                return [a, gap - a]
        # triples: the pair sums that the gap less a third length asks for, longest thirds first
        thirds = there[there <= gap // 3][::-1]
        for at in range(0, len(thirds), 64):
            third = thirds[at : at + 64, None]
            rest = gap - third - there[None, :]
            fits = (there[None, :] >= third) & (rest >= there[None, :])
            fits &= self.counts[np.maximum(rest, 0)] > 0
            for i, j in np.argwhere(fits)[::-1].tolist():
                found = [int(rest[i, j]), int(there[j]), int(third[i, 0])]
                if self.has(used + found):
                    return found
        return None

    def best(self, gap: int, used: list[int]) -> list[int]:
        """Longest lengths that fit, one after the other."""
        found: list[int] = []
        while gap > 0:
            fits = np.flatnonzero(self.counts[1 : gap + 1])[::-1] + 1
            pick = next((int(x) for x in fits if self.counts[x] > (used + found).count(int(x))), None)
            if pick is None:
                break
            # as many of this length as fit and are there
            times = min(gap // pick, int(self.counts[pick]) - (used + found).count(pick))
            found += [pick] * times
            gap -= pick * times
        return found

    def take(self, lengths: list[int]) -> int:
        """Consume the combination as often as its lengths last; how often that was."""
        kinds, needs = np.unique(lengths, return_counts=True)
        times = int((self.counts[kinds] // needs).min())
        self.counts[kinds] -= needs * times
        return times


def plan_packing(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Combinations of lengths and how many sequences hold each; ``counts[l]`` pieces have length l."""
    left, plan = _Available(counts), []
    for length in range(capacity, 0, -1):
        while left.counts[length]:
            gap = capacity - length
            rest = (left.exact(gap, [length]) or left.best(gap, [length])) if gap else []
            plan.append(([length, *rest], left.take([length, *rest])))
    return plan


def _runs(plan: list[tuple[list[int], int]], capacity: int) -> dict[str, np.ndarray]:
    """For each run of equal lengths: first rank, first sequence, and offset within it."""
    rows, used, sequence = [], np.zeros(capacity + 1, np.int64), 0
    for lengths, times in plan:
        offset = 0
        for length in lengths:
            rows.append((length, used[length], sequence, offset))
            used[length] += times
            offset += length
        sequence += times
    table = np.array(rows, np.int64).reshape(-1, 4)
    # ranks of one length grow with the plan, so a stable sort by length keeps them sorted
    table = table[np.argsort(table[:, 0], kind="stable")]
    return dict(zip(("length", "rank", "sequence", "offset"), table.T.copy(), strict=True))


def _placed(runs: dict[str, np.ndarray], capacity: int):
    first = np.searchsorted(runs["length"], np.arange(capacity + 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            at = np.empty(len(length), np.int64)
            for kind in np.unique(length):
                own = np.flatnonzero(length == kind)
                a, b = first[kind], first[kind + 1]
                at[own] = a + np.searchsorted(runs["rank"][a:b], rank[own], "right") - 1
            sequence = runs["sequence"][at] + rank - runs["rank"][at]
            columns = {c: batch.column(c) for c in batch.schema.names if c != "rank"}
            yield pa.record_batch(columns | {"sequence_id": pa.array(sequence), "offset": pa.array(runs["offset"][at])})

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to rows of doc_id, piece, start, length, ids_crc32."""
    order = ["length", "doc_id", "piece", "ids_crc32"]
    histogram = pieces.groupBy("length").count().collect()  # at most ``capacity`` rows
    counts = np.zeros(capacity + 1, np.int64)
    for row in histogram:
        counts[row["length"]] = row["count"]
    runs = _runs(plan_packing(counts, capacity), capacity)
    ordered = running_sums(in_blocks(pieces, order), order, {"before": F.lit(1)})
    shorter = np.concatenate([[0], np.cumsum(counts)[:-1]])
    firsts = pieces.sparkSession.createDataFrame([(int(k), int(shorter[k])) for k in np.flatnonzero(counts)], "length long, shorter long")
    ranked = ordered.join(firsts, "length").select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") - F.col("shorter")).alias("rank"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return in_tasks(ranked, _placed(runs, capacity), schema)


def _cut(vocabulary: str, path: str | None, end: int, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, path).encode
        for batch in batches:
            for row, stop, data, offsets in text_slices(batch.column("text"), SLICE):
                ids, bounds = encode(data, offsets, end)
                sizes = np.diff(bounds)
                parts = -(-sizes // capacity)
                doc = np.repeat(np.arange(len(sizes)), parts)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
                start = piece * capacity
                length = np.minimum(capacity, sizes[doc] - start)
                raw = ids.astype("<u4")
                spans = [raw[a : a + n] for a, n in zip((bounds[doc] + start).tolist(), length.tolist(), strict=True)]
                out = {
                    "doc_id": batch.column("doc_id").take(pa.array(row + doc)),
                    "piece": pa.array(piece.astype(np.int32)),
                    "start": pa.array(start),
                    "length": pa.array(length),
                    "ids_crc32": pa.array([zlib.crc32(s) for s in spans], pa.int64()),
                }
                if with_ids:
                    out["ids"] = pa.array([s.view(np.int32) for s in spans], pa.list_(pa.int32()))
                yield pa.record_batch(out)

    return run


def token_pieces(
    docs: DataFrame,
    capacity: int = CAPACITY,
    vocabulary: str = VOCABULARY,
    vocabulary_path: str | None = None,
    end: int = END,
    with_ids: bool = False,
) -> DataFrame:
    """The pieces of each document: doc_id, piece, start, length, ids_crc32 (and ids)."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return in_tasks(docs.select("doc_id", "text"), _cut(vocabulary, vocabulary_path, end, capacity, with_ids), schema)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece, with its sequence and its offset there."""
    return pack(materialise(token_pieces(docs, capacity), "token_pieces"), capacity)


def packed_sequences(docs: DataFrame, packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The sequences themselves: sequence_id and its ids, at most ``capacity`` of them."""
    key = ["doc_id", "piece", "ids_crc32"]
    pieces = token_pieces(docs, capacity, with_ids=True).select(*key, "ids").dropDuplicates(key)
    parts = packed.join(pieces, [packed[c].eqNullSafe(pieces[c]) for c in key]).select(packed["sequence_id"], packed["offset"], pieces["ids"])
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return parts.groupBy("sequence_id").agg(F.flatten(F.transform(ordered, lambda p: p["ids"])).alias("ids"))
