"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared in lower case, with every run of ASCII characters other than letters
and digits as one space. An item of m bytes may differ by m // SHARE bytes inserted,
deleted or replaced (5 %), and by WORD bytes (about one word) at least, or m // LEAST
where that is less. It is split into one piece more than that, so a passage within the
budget holds one piece unchanged. All pieces are sought at once in each whole document.
A hit's neighbourhood grows by doubling: of two halves of a part within its budget, one
is within its share of the budget, so a hit whose part is over it is dropped early. Hits
of one item on nearby diagonals are one region, and Myers' bit-parallel distance over
that region verifies it.

Items under ``SHORT`` bytes match exactly, as whole words. An item without letters or
digits matches nothing. The benchmark goes to the executors in blocks of
``BLOCK_BYTES`` at most, one pass over the documents for each block, so its size is
bounded whatever the table holds. Null texts and null items match nothing. Repeated
rows are judged alike. Columns other than those named are ignored. Empty tables give
empty results.
"""

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upcharts.llm.positions import in_blocks, running_sums
from upcharts.llm.ship import in_tasks
from upcharts.session import materialise

SHARE, WORD, LEAST = 20, 8, 6
SHORT = 20
BLOCK_BYTES = 4 << 20

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def comparable(text: str | None) -> bytes:
    """The form in which documents and items are compared."""
    return b" ".join((text or "").lower().encode().translate(_FOLD).split())


def budget(size: int) -> int:
    """Bytes by which a passage may differ from an item of ``size`` bytes."""
    return 0 if size < SHORT else max(size // SHARE, min(WORD, size // LEAST))


def pieces_of(item: bytes) -> list[tuple[int, bytes]]:
    """``budget + 1`` pieces that cover the item, with their offsets."""
    count = budget(len(item)) + 1
    ends = [len(item) * k // count for k in range(count + 1)]
    return [(a, item[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def leaves_of(ends: list[int]) -> list[tuple | None]:
    """For each piece, the parts of the item above it, as (start, end, errors, part above).

    A part of n pieces may hold n - 1 errors; the whole item is left out.
    """
    out = []

    def split(low: int, high: int, above: tuple | None) -> None:
        if high - low == 1:
            out.append(above)
            return
        here = above if high - low == len(ends) - 1 else (ends[low], ends[high], high - low - 1, above)
        middle = (low + high) // 2
        split(low, middle, here)
        split(middle, high, here)

    split(0, len(ends) - 1, None)
    return out


def myers(pattern: bytes, text: bytes, anchored: bool = False) -> tuple[int, int]:
    """Least distance of ``pattern`` to a part of ``text``, and where the first such part ends.

    Anchored parts begin where the text begins.
    """
    m = len(pattern)
    peq: dict[int, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        peq[c] |= 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, where = m, 0
    for j, c in enumerate(text):
        eq = peq.get(c, 0)
        diagonal = (((eq & plus) + plus) ^ plus) | eq | minus
        up = minus | (~(diagonal | plus) & full)
        down = plus & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = (up << 1 | anchored) & full
        down = (down << 1) & full
        vertical = eq | minus
        plus = down | (~(vertical | up) & full)
        minus = up & vertical
        if score < best:
            best, where = score, j + 1
    return best, where


class Matcher:
    """Finds passages of a block of items in texts."""

    def __init__(self, items: list[tuple[int, bytes]]):
        import ahocorasick

        self.items = items
        places: dict[str, list[tuple[int, int, tuple | None]]] = defaultdict(list)
        for number, (_, item) in enumerate(items):
            if item:
                pieces = pieces_of(item)
                for (at, piece), above in zip(pieces, leaves_of([*[a for a, _ in pieces], len(item)]), strict=True):
                    places[piece.decode("latin-1")].append((number, at, above))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()
        self.empty = not places

    def _holds(self, text: bytes, number: int, diagonal: int, above: tuple | None) -> bool:
        """Whether all parts above a hit are within their errors; short items need word bounds."""
        item = self.items[number][1]
        if len(item) < SHORT:
            end = diagonal + len(item)
            return (diagonal == 0 or text[diagonal - 1] == 32) and (end == len(text) or text[end] == 32)
        while above:
            low, high, errors, above = above
            part = text[max(0, diagonal + low - errors) : max(0, diagonal + high + errors)]
            if myers(item[low:high], part)[0] > errors:
                return False
        return True

    def _regions(self, text: bytes) -> dict[int, list[tuple[int, int]]]:
        """Ranges of diagonals with a piece hit, by item."""
        diagonals = defaultdict(set)
        for end, (size, where) in self.automaton.iter(text.decode("latin-1")):
            for number, at, above in where:
                diagonal = end + 1 - size - at
                if diagonal not in diagonals[number] and self._holds(text, number, diagonal, above):
                    diagonals[number].add(diagonal)
        out = {}
        for number, found in diagonals.items():
            near = 2 * budget(len(self.items[number][1])) + 1
            ranges = []
            for d in sorted(found):
                # a range longer than the item is closed, so that no region grows without bound
                if ranges and d - ranges[-1][1] <= near and d - ranges[-1][0] <= len(self.items[number][1]):
                    ranges[-1][1] = d
                else:
                    ranges.append([d, d])
            out[number] = [tuple(r) for r in ranges]
        return out

    def find(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item_id, distance, start, end) of the best passage of each item found."""
        if self.empty or not text:
            return []
        folded = comparable(text)
        out = []
        for number, ranges in self._regions(folded).items():
            item_id, item = self.items[number]
            allowed = budget(len(item))
            best = None
            for low, high in ranges:
                a = max(0, low - allowed)
                b = min(len(folded), high + len(item) + allowed)
                if folded[low : low + len(item)] == item and low >= 0:
                    found = (0, low, low + len(item))
                else:
                    distance, end = myers(item, folded[a:b])
                    if distance > allowed:
                        continue
                    back = myers(item[::-1], folded[a : a + end][::-1], anchored=True)[1]
                    found = (distance, a + end - back, a + end)
                best = min(best, found) if best else found
            if best:
                out.append((item_id, *best))
        return sorted(out)


_matchers: dict[int, Matcher] = {}


def _matcher(block) -> Matcher:
    """The worker's matcher of a broadcast block; one is kept at a time."""
    if block.id not in _matchers:
        _matchers.clear()
        _matchers[block.id] = Matcher(block.value)
    return _matchers[block.id]


class _Block:
    """A broadcast block of items under an id that workers can know it by."""

    def __init__(self, broadcast, number: int):
        self.broadcast, self.id = broadcast, number

    @property
    def value(self):
        return self.broadcast.value


def _hits(block: _Block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(block)
        for batch in batches:
            rows, found = [], []
            for row, text in enumerate(batch.column("text")):
                hits = matcher.find(text.as_py())
                rows += [row] * len(hits)
                found += hits
            columns = list(zip(*found, strict=True)) if found else [[]] * 4
            out = {"doc_id": batch.column("doc_id").take(pa.array(rows, pa.int64()))}
            for name, values in zip(("item_id", "distance", "start", "end"), columns, strict=True):
                out[name] = pa.array(values, pa.int64())
            yield pa.record_batch(out)

    return run


def _clean(block: _Block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(block)
        for batch in batches:
            yield batch.filter(pa.array([not matcher.find(t.as_py()) for t in batch.column("text")], pa.bool_()))

    return run


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> list[_Block]:
    """The items in broadcast blocks of bounded size."""
    spark = benchmark.sparkSession
    items = benchmark.where("text is not null").select("item_id", "text", F.octet_length("text").alias("size")).distinct()
    if (items.agg(F.sum("size")).first()[0] or 0) > block_bytes:
        order = ["item_id", "text"]
        placed = running_sums(in_blocks(items, order), order, {"before": F.col("size")})
        numbered = placed.withColumn("part", F.floor(F.col("before") / block_bytes))
        parts = [numbered.where(F.col("part") == r["part"]) for r in numbered.select("part").distinct().orderBy("part").toLocalIterator()]
    else:
        parts = [items]
    blocks = []
    for part in parts:
        rows = [(r["item_id"], comparable(r["text"])) for r in part.select("item_id", "text").collect()]
        broadcast = spark.sparkContext.broadcast(rows)
        blocks.append(_Block(broadcast, broadcast._jbroadcast.id()))
    return blocks


def find_leaks(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, distance, start, end.

    The place is that of the best passage, in bytes of the comparable text.
    """
    schema = "doc_id long, item_id long, distance long, start long, end long"
    out = None
    for block in item_blocks(benchmark, block_bytes):
        hits = in_tasks(docs.select("doc_id", "text"), _hits(block), schema)
        out = hits if out is None else out.unionByName(hits)
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns.

    With several blocks of items, the rows are stored between them, so a task runs one
    Python worker and holds one block.
    """
    blocks = item_blocks(benchmark, block_bytes)
    for number, block in enumerate(blocks, 1):
        docs = in_tasks(docs, _clean(block), docs.schema)
        if number < len(blocks):
            docs = materialise(docs, "clean_rows")
    return docs
