"""Jaccard join on word n-grams by parity sketches.

A document's set holds its distinct shingles of ``shingle`` words (fewer words: the whole
sequence as one). Documents link when 100 * intersection >= percent * union.

1. Sizes are cut into bands, each as wide as linked sizes can lie apart, so that linked
   documents lie in one band or in neighbouring ones. A document takes part in the join
   of its own band with the next one, and of the band before with its own.
2. Linked sets of a and b shingles differ in at most (a + b)(100 - percent)/(100 + percent)
   of them; d is the largest such number of a band. The shingle hashes are dealt over
   d + 1 + s parts, so linked sets hold the same shingles in at least 1 + s of them
   (pigeonhole). The keys are the d + 1 parts with the most shingles: of the equal parts
   the fullest has s others before it in either set, so it is a key of both. Where d is
   4 or less, there are d + 2 parts, of which two must agree, and keys are pairs of parts.
   The keys lose no link, whatever the data.
   A key is 64 parities, each over a random half of the part's shingles. Parts that only
   look alike would meet the more often the larger the table is, and so would parts that
   are (almost) empty; the former do not occur, and s leaves out the latter.
3. Documents with equal sets are one class. Classes that share a key meet in the
   groups of ``groups.py``. There a sketch has 64 bits a part, and each shingle flips one
   bit of its part, so two sketches differ in at most as many bits as the sets differ in
   shingles: pairs whose sketches differ in more bits than their sizes allow are left
   out, the others are verified on whole sets.

Null or wordless texts are linked with nothing. Rows that share a doc_id count as one
node, null doc_ids too. Repeated rows all appear in the result. Other columns are
ignored, whatever their names. An empty table gives an empty result.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upcharts.llm.groups import Filter, as_lists, digest, document_groups, group_links, set_classes, shingle_sets
from upcharts.llm.ship import in_tasks
from upcharts.llm.text import mix, row_key, signed
from upcharts.session import materialise

SHINGLE, PERCENT = 3, 90
#: up to this many differing shingles, two parts have to agree
FEW = 4


def size_bands(percent: int) -> list[int]:
    """The least size of each band, up to 2^40."""
    bounds = [1]
    while bounds[-1] < 1 << 40:
        bounds.append(bounds[-1] * 100 // percent + 1)
    return bounds


def most_apart(a, b, percent: int):
    """How many shingles linked sets of a and b shingles differ in at most."""
    return (a + b) * (100 - percent) // (100 + percent)


class Layout:
    """Bands of sizes, and the parts of the sketches of each band's join."""

    def __init__(self, percent: int):
        self.percent = percent
        self.bounds = np.array(size_bands(percent), np.int64)

    def band(self, n: int) -> int:
        return int(np.searchsorted(self.bounds, n, "right")) - 1

    def apart(self, band: int) -> int:
        """d of the band's join: its largest size with the largest that can link to it."""
        largest = int(self.bounds[band + 1]) - 1
        return most_apart(largest, largest * 100 // self.percent, self.percent)

    def spare(self, band: int) -> int:
        """How many of the parts, the emptiest of a set, are no keys."""
        d = self.apart(band)
        return 1 + d // 8 if d > FEW else 0

    def parts(self, band: int) -> int:
        d = self.apart(band)
        return d + 2 if 0 < d <= FEW else d + 1 + self.spare(band)

    def part(self, values: np.ndarray, band: int) -> np.ndarray:
        """The part of each shingle; ascending, if the shingles are."""
        return ((values >> np.uint64(32)) * np.uint64(self.parts(band))) >> np.uint64(32)

    def sketch(self, values: np.ndarray, band: int) -> np.ndarray:
        """The parities of the shingles that fall on each bit, 64 bits a part."""
        parts = self.parts(band)
        place = self.part(values, band) * np.uint64(64) + (values & np.uint64(63))
        odd = np.bincount(place.astype(np.int64), minlength=64 * parts).astype(np.uint8) & 1
        return np.packbits(odd, bitorder="little").view(np.uint64)

    def keys(self, values: np.ndarray, band: int) -> np.ndarray:
        """Hashes of the fullest parts, or of pairs of parts, one of which linked sets share; ``values`` ascend."""
        d = self.apart(band)
        if d == 0:
            # only equal sets link, and they are one class
            return np.empty(0, np.uint64)
        bounds = np.searchsorted(self.part(values, band), np.arange(self.parts(band) + 1, dtype=np.uint64))
        parities = np.concatenate((np.zeros(1, np.uint64), np.bitwise_xor.accumulate(mix(values))))[bounds]
        words = parities[1:] ^ parities[:-1]
        if d > FEW:
            # among parts of the same size, the first ones come first in every set
            fullest = np.argsort(np.diff(bounds), kind="stable")[self.spare(band) :]
            return mix(words[fullest] ^ mix((fullest + 1).astype(np.uint64)))
        one, two = (np.array(side) for side in zip(*combinations(range(len(words)), 2), strict=True))
        return mix(mix(words[one] ^ mix((one * 8 + two + 1).astype(np.uint64))) + words[two])


def _sketches(shingle: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layout = Layout(percent)
        none = np.empty(0, np.uint64)
        for batch in batches:
            n, band, digests, own, below = [], [], [], [], []
            for values in shingle_sets(batch.column("text"), shingle):
                at = layout.band(len(values)) if len(values) else 0
                n.append(len(values))
                band.append(at)
                digests.append(digest(values))
                own.append(layout.keys(values, at) if len(values) else none)
                below.append(layout.keys(values, at - 1) if at else none)
            if not n:
                continue
            sums = np.array(digests, np.uint64)
            yield pa.record_batch(
                {
                    "_id": batch.column("_id"),
                    "_check": batch.column("_check"),
                    "n": pa.array(n, pa.int64()),
                    "band": pa.array(band, pa.int32()),
                    "one": signed(np.ascontiguousarray(sums[:, 0])),
                    "two": signed(np.ascontiguousarray(sums[:, 1])),
                    "own": as_lists(own),
                    "below": as_lists(below),
                }
            )

    return run


def _by_parity(percent: int):
    """Of a group: pairs whose sketches differ in no more bits than linked sets of their sizes."""

    def filter_of(members: pa.StructArray, sets: list[np.ndarray], band: int) -> Filter:
        layout = Layout(percent)
        bits = np.array([layout.sketch(s, band) for s in sets])
        n = np.array([len(s) for s in sets], np.int64)

        def may_link(i: int, j: np.ndarray) -> np.ndarray:
            differ = np.bitwise_count(bits[j] ^ bits[i]).sum(axis=1, dtype=np.int64)
            return j[differ <= most_apart(n[j], n[i], percent)]

        return may_link

    return filter_of


def ngram_join(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (least doc_id reachable by links)."""
    texts = docs.select(*row_key(), "text")
    sketches = materialise(
        in_tasks(texts, _sketches(shingle, percent), "_id long, _check long, n long, band int, one long, two long, own array<long>, below array<long>"),
        "parity_sketches",
    )
    classes = set_classes(sketches, ["band", "own", "below"])
    own = classes.select(F.col("band").alias("kind"), "rep", F.explode("own").alias("bucket"))
    below = classes.select((F.col("band") - 1).alias("kind"), "rep", F.explode("below").alias("bucket"))
    links = group_links(
        own.union(below), classes.select("rep", "n", "first._id", "first._check"), texts, shingle, percent, _by_parity(percent)
    )
    return document_groups(sketches, classes, links)
