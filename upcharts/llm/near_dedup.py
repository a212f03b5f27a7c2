"""Near-duplicate groups by b-bit MinHash, confirmed on whole shingle sets.

A document's set holds its distinct shingles of ``shingle`` words, 4 in the groups and 5
where near copies are dropped unless told (fewer words: the whole sequence as one). Documents link when 100 * intersection >= 80 * union.

1. One pass makes a sketch of each set: 128 minima, of which 4 bits each are kept and
   packed in bit planes, and 32 band keys of 4 minima. Documents with equal sets become
   one class, so copies cost nothing further.
2. Classes that share a band key are candidates. A pair at similarity 0.8 shares none
   with probability (1 - 0.8^4)^32 = 5e-8.
3. Candidates meet in the groups of ``groups.py``. A pair passes if its collision-corrected
   estimate (matching minima - 1/16) / (15/16), by bit counts over the packed signatures,
   is no more than five standard errors below 0.8; then it is confirmed on whole sets.

Null or wordless texts are linked with nothing. Classes have numbers of their own; doc_ids come in at the end. In
the groups, rows that share a doc_id count as one node, null doc_ids too, whatever their
texts. Where near copies are dropped, rows of one doc_id are linked by their texts only,
and of equal rows (doc_id and text) all stay or none. Other columns are ignored, whatever
their names. An empty table gives an empty result.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upcharts.llm.groups import Filter, digest, document_groups, group_links, labelled, set_classes, shingle_sets
from upcharts.llm.prefilter import marked
from upcharts.llm.ship import in_tasks
from upcharts.llm.text import mix, row_key, signed
from upcharts.session import materialise

# words of a shingle: in the groups, and where near copies are dropped
SHINGLE, STAGE_SHINGLE = 4, 5
MINIMA, BITS, BANDS = 128, 4, 32
ROWS = MINIMA // BANDS
PERCENT = 80

_random = np.random.default_rng(20261203)
_A = _random.integers(0, 1 << 32, MINIMA, dtype=np.uint32) | np.uint32(1)
_B = _random.integers(0, 1 << 32, MINIMA, dtype=np.uint32)


def lowest_estimate(percent: int = PERCENT) -> float:
    """Five standard errors of the corrected estimate below the wanted similarity."""
    chance = 1 / (1 << BITS)
    match = percent / 100 + (1 - percent / 100) * chance
    return percent / 100 - 5 * (match * (1 - match) / MINIMA) ** 0.5 / (1 - chance)


def _minima(values: np.ndarray) -> np.ndarray:
    out = np.full(MINIMA, (1 << 32) - 1, np.uint32)
    for at in range(0, len(values), 8192):
        part = (values[at : at + 8192] >> np.uint64(32)).astype(np.uint32)
        table = part[None, :] * _A[:, None]
        table += _B[:, None]
        np.minimum(out, table.min(axis=1), out=out)
    return out


def _packed(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=-1, bitorder="little").view(np.uint64)


def _lists(values: np.ndarray) -> pa.Array:
    rows, width = values.shape
    flat = pa.array(np.ascontiguousarray(values).ravel().view(np.int64))
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * width), flat)


def _sketches(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, digests, minima = [], [], []
            for values in shingle_sets(batch.column("text"), shingle):
                n.append(len(values))
                digests.append(digest(values))
                minima.append(_minima(values))
            if not n:
                continue
            sums = np.array(digests, np.uint64)
            least = np.array(minima, np.uint32)
            low = (least * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
            planes = [_packed((low >> np.uint32(k)) & np.uint32(1)) for k in range(BITS)]
            bands = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(n), 1))
            for k in range(ROWS):
                bands = mix(bands * np.uint64(0x9E3779B97F4A7C15) + least[:, k::ROWS].astype(np.uint64))
            yield pa.record_batch(
                {
                    "_id": batch.column("_id"),
                    "_check": batch.column("_check"),
                    "n": pa.array(n, pa.int64()),
                    "one": signed(np.ascontiguousarray(sums[:, 0])),
                    "two": signed(np.ascontiguousarray(sums[:, 1])),
                    "bits": _lists(np.concatenate(planes, axis=1)),
                    "bands": _lists(bands),
                }
            )

    return run


def _by_estimate(percent: int):
    """Of a group: pairs whose collision-corrected estimate leaves a link possible."""

    def filter_of(members: pa.StructArray, sets: list[np.ndarray], kind: int) -> Filter:
        bits = members.field("bits").flatten().to_numpy().view(np.uint64).reshape(len(sets), BITS, MINIMA // 64)
        chance, lowest = 1 / (1 << BITS), lowest_estimate(percent)

        def may_link(i: int, j: np.ndarray) -> np.ndarray:
            differ = np.bitwise_or.reduce(bits[j] ^ bits[i], axis=1)
            missed = np.bitwise_count(differ).sum(axis=1, dtype=np.int64)
            return j[((MINIMA - missed) / MINIMA - chance) / (1 - chance) >= lowest]

        return may_link

    return filter_of


def _linked_classes(docs: DataFrame, percent: int, shingle: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sketches of all rows, classes of equal sets (numbered ``rep``), and links between classes."""
    texts = docs.select(*row_key(), "text")
    sketches = materialise(
        in_tasks(texts, _sketches(shingle), "_id long, _check long, n long, one long, two long, bits array<long>, bands array<long>"),
        "sketches",
    )
    classes = set_classes(sketches, ["bits", "bands"])
    members = classes.select(F.lit(0).alias("kind"), "rep", F.explode("bands").alias("bucket"))
    links = group_links(
        members, classes.select("rep", "n", "first._id", "first._check", "bits"), texts, shingle, percent, _by_estimate(percent)
    )
    return sketches, classes, links


def near_groups(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    grouped = document_groups(*_linked_classes(docs, percent, shingle))
    return grouped.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_copies(docs: DataFrame, percent: int = PERCENT, shingle: int = STAGE_SHINGLE) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each group, and all without words."""
    sketches, classes, links = _linked_classes(docs, percent, shingle)
    worded = labelled(classes, links).select("least._id", "least._check").distinct()
    wordless = sketches.where("n = 0").select("_id", "_check")
    # fewer rows go than stay, so whole rows meet those that go
    key = ["_id", "_check"]
    gone = materialise(sketches.select(*key).distinct().join(worded.union(wordless), key, "left_anti"), "near_copies")
    # the rows stand in a struct of their own, so that none of their columns can clash
    rows = marked(docs.select(F.struct("*").alias("row"), *row_key()), gone, key)
    maybe = rows.where("_maybe").join(gone, key, "left_anti")
    return rows.where("NOT _maybe").select("row.*").union(maybe.select("row.*"))
