"""Spelling variants by a variable-length gram index.

Two words are near if they differ by exactly one inserted, deleted or replaced code
point. A word's form is its near word of largest count (ties: least in code-point order)
if that count is at least twice its own; forms are followed to the root.

1. Dictionary: grams of 2 to 5 code points that occur more than ``LIST`` times in the
   words (more, if there were over ``DICTIONARY`` of them: its size is bounded).
2. A word, closed by an end mark, is decomposed into one gram at each place: two code
   points, and longer while the gram is in the dictionary, up to the end or half the
   length of the shorter word of the pairs looked for (6 at most). A gram depends on nothing
   but the code points it covers, so an edit changes only grams that cover its place. The
   most grams over one place are the word's bound B: of its n grams, n - B stay at least,
   and as any edit spares one half of a word, at least one.
3. Index: near words share n - B grams or more, so they meet in a list among the B + 1
   least frequent grams of each (dictionary grams come last, by count). Words of an even length
   are decomposed twice, for partners of the same or larger and of smaller length.
4. Lists merge in blocks: a pair of a list goes on if the gram stands at the same place
   from the start or the end, and if the two words share n - B grams of either word; then the
   edit is verified. A pair counts in the first of the lists it shares. Each block
   returns one row per word (count of near words, best near word), never its pairs.
5. Roots by pointer doubling; counts at least double along forms, so chains are short.

Lists over ``BLOCK`` words are cut, and each two blocks of a list meet in a task. Words
come from whole texts (null: none), at least 5 code points long. A null doc_id counts as
an empty one. Repeated rows count each. Other columns are ignored. No words, no rows.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upcharts.llm.ship import in_tasks
from upcharts.session import materialise

RUN = "[A-Za-zÀ-ÿ]+"
MIN_LENGTH, MIN_COUNT = 5, 3
SHORTEST, LONGEST = 2, 6
LIST, DICTIONARY = 64, 1 << 18
BLOCK = 2048
#: words over this length are compared one by one
WIDE = 48
#: pairs looked at together
PAIRS = 1 << 20

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_END = "\n"


def runs(docs: DataFrame) -> DataFrame:
    """doc_id and each maximal run of letters, A-Z lower-cased."""
    lower = F.translate("text", _UPPER, _UPPER.lower())
    return docs.select("doc_id", F.explode(F.regexp_extract_all(lower, F.lit(RUN), F.lit(0))).alias("run"))


def misspelt(found: DataFrame, one_in: int = 97) -> DataFrame:
    """One run in ``one_in``, by crc32 of ``doc_id:run``, loses the code point that the crc32 points at."""
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")))
    at = (F.col("h") % F.length("run")).cast("int")
    short = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return found.withColumn("h", h).select("doc_id", F.when(F.col("h") % one_in == 0, short).otherwise(F.col("run")).alias("run"))


def word_counts(found: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n: runs of at least so many code points that occur so often."""
    counted = found.where(F.length("run") >= min_length).groupBy(F.col("run").alias("word")).agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= min_count)


def frequent_grams(words: DataFrame) -> dict[str, int]:
    """Grams that are extended, with their counts; fewer than ``DICTIONARY``."""
    closed = words.select(F.concat("word", F.lit(_END)).alias("s"))
    spread = closed.select("s", F.explode(F.sequence(F.lit(1), F.length("s") - 1)).alias("at"))
    lengths = F.explode(F.sequence(F.lit(SHORTEST), F.least(F.lit(LONGEST - 1), F.length("s") - F.col("at") + 1))).alias("q")
    grams = spread.select("s", "at", lengths).groupBy(F.substring("s", F.col("at"), F.col("q")).alias("gram")).agg(F.count("*").alias("n"))
    grams = materialise(grams.where(F.col("n") > LIST), "frequent_grams")
    total = grams.agg(F.sum("n")).first()[0] or 0
    return {r["gram"]: r["n"] for r in grams.where(F.col("n") > max(LIST, total // DICTIONARY)).toLocalIterator()}


def longest_gram(length: int) -> int:
    """Longest gram for pairs whose shorter word has so many code points: two fit into it."""
    return min(LONGEST, length // 2)


def decompose(word: str, longest: int, frequent: dict[str, int]) -> tuple[list[tuple[int, str]], int]:
    """(place, gram) at each place of ``word``, and the most grams over one place."""
    closed = word + _END
    size, grams = len(closed), []
    steps = [0] * (size + 1)
    for at in range(size - 1):
        end = at + SHORTEST
        while end - at < longest and end < size and closed[at:end] in frequent:
            end += 1
        grams.append((at, closed[at:end]))
        steps[at] += 1
        steps[end] -= 1
    most = over = 0
    for step in steps:
        over += step
        most = max(most, over)
    return grams, most


def indexed(word: str, longest: int, frequent: dict[str, int]) -> tuple[list[int], list[int], int]:
    """A word's gram tokens, least frequent first, their places (-1: several), and how many are indexed.

    The k-th occurrence of a gram is a token of its own.
    """
    grams, most = decompose(word, longest, frequent)
    seen: dict[str, int] = {}
    tokens = []
    for at, gram in grams:
        nth = seen[gram] = seen.get(gram, 0) + 1
        tokens.append((frequent.get(gram, 0), zlib.crc32(f"{longest}:{nth}:{gram}".encode()), at, gram))
    tokens.sort()
    return [t[1] for t in tokens], [t[2] if seen[t[3]] == 1 else -1 for t in tokens], most + 1


def _decomposed(frequent: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True):
                shorter = max(len(word) - 1, MIN_LENGTH)
                for longest in {longest_gram(len(word)), longest_gram(shorter)}:
                    rows.append((longest, word, n, *indexed(word, longest, frequent)))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 6
            kinds = [pa.int32(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int32()]
            names = ["longest", "word", "n", "tokens", "places", "k"]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return run


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one code point is inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    at = 0
    while at < len(a) and a[at] == b[at]:
        at += 1
    return a != b and len(b) - len(a) <= 1 and a[at + (len(a) == len(b)) :] == b[at + 1 :]


def _ragged(column: pa.ListArray, short: np.ndarray, fill: int) -> np.ndarray:
    """Lists as rows of a matrix; rows that are not ``short`` stay empty."""
    lengths = np.diff(column.offsets.to_numpy())
    values, row = column.flatten().to_numpy(), np.repeat(np.arange(len(column)), lengths)
    begins = np.cumsum(lengths) - lengths
    out = np.full((len(column), int(lengths[short].max(initial=1))), fill, np.int64)
    held = short[row]
    out[row[held], (np.arange(len(values)) - begins[row])[held]] = values[held]
    return out


class Members:
    """The members of many lists at once, as arrays."""

    def __init__(self, batch: pa.RecordBatch):
        lists = batch.column("members")
        size = np.diff(lists.offsets.to_numpy())
        rows = lists.flatten()
        self.words = rows.field("word").to_pylist()
        self.n = rows.field("n").to_numpy()
        self.place = rows.field("place").to_numpy()
        self.k = rows.field("k").to_numpy()
        self.length = np.array([len(w) for w in self.words], np.int64)
        self.list = np.repeat(batch.column("list").to_numpy(), size)
        self.longest = np.repeat(batch.column("longest").to_numpy(), size)
        self.tokens, self.places = rows.field("tokens"), rows.field("places")
        # partners of each member: those behind it in its list, or the other block
        end = np.repeat(np.cumsum(size), size)
        part = rows.field("part").to_numpy()
        begin = np.repeat(np.cumsum(size) - size, size)
        two = np.repeat(np.maximum.reduceat(part, np.cumsum(size) - size) != np.minimum.reduceat(part, np.cumsum(size) - size), size)
        here = np.arange(len(part))
        # members are sorted by part, so the other block begins where the part changes
        changed = np.flatnonzero(np.diff(part) != 0) + 1
        at = np.searchsorted(changed, here, "right")
        second = np.append(changed, len(part))[np.minimum(at, len(changed))]
        in_first = part == part[begin]
        self.low = np.where(two, np.where(in_first, second, end), here + 1)
        self.end = end
        short = self.length <= WIDE
        self.short = short
        kept = [w if s else "" for w, s in zip(self.words, short.tolist(), strict=True)]
        width = int(self.length[short].max(initial=1))
        self.front = np.array(kept, f"<U{width}").view(np.uint32).reshape(len(kept), width)
        self.back = np.array([w[::-1] for w in kept], f"<U{width}").view(np.uint32).reshape(len(kept), width)
        self.matrix, self.place_of = _ragged(self.tokens, short, -1), _ragged(self.places, short, -1)

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All pairs of a list that are looked at, some at a time."""
        counts = np.maximum(self.end - self.low, 0)
        done, total = 0, np.concatenate(([0], np.cumsum(counts)))
        while done < len(counts):
            stop = max(done + 1, int(np.searchsorted(total, total[done] + PAIRS, "right")) - 1)
            some = counts[done:stop]
            i = np.repeat(np.arange(done, stop), some)
            yield i, np.arange(len(i)) - np.repeat(np.cumsum(some) - some, some) + np.repeat(self.low[done:stop], some)
            done = stop

    def fits(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Lengths that belong to this decomposition, and the list's gram at one place from either end."""
        a, b, p, q = self.length[i], self.length[j], self.place[i], self.place[j]
        lengths = (np.abs(a - b) <= 1) & (np.minimum(LONGEST, np.minimum(a, b) // 2) == self.longest[i])
        return lengths & ((p < 0) | (q < 0) | (p == q) | (a - p == b - q))

    def _tokens(self, i: int) -> list[int]:
        return self.tokens[i].as_py()

    def merged(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether the words share as many grams as one edit leaves of either."""
        # n grams, of which k - 1 may be affected
        least = np.maximum(self.length[i] - self.k[i], self.length[j] - self.k[j]) + 1
        out = np.zeros(len(i), bool)
        step = max(1, (1 << 22) // self.matrix.shape[1] ** 2)
        for at in range(0, len(i), step):
            a, b = self.matrix[i[at : at + step]], self.matrix[j[at : at + step]]
            common = ((a[:, :, None] == b[:, None, :]) & (a >= 0)[:, :, None]).sum(axis=(1, 2))
            out[at : at + step] = common >= least[at : at + step]
        return out

    def near(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The edit itself: what the words share at the front and at the back covers all but one."""
        shared = lambda m: np.argmin(np.column_stack((m[i] == m[j], np.zeros(len(i), bool))), axis=1)
        a, b = self.length[i], self.length[j]
        return shared(self.front) + shared(self.back) >= np.maximum(a, b) - 1

    def first_shared(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether this list is the first of those in which the pair meets."""
        out = np.zeros(len(i), bool)
        width = min(self.matrix.shape[1], int(self.k[self.short].max(initial=1)))
        held = np.arange(width)
        for at in range(0, len(i), 1 << 15):
            x, y = i[at : at + (1 << 15)], j[at : at + (1 << 15)]
            a, b = self.matrix[x, :width], self.matrix[y, :width]
            p, q = self.place_of[x, :width][:, :, None], self.place_of[y, :width][:, None, :]
            same = a[:, :, None] == b[:, None, :]
            same &= (held < self.k[x][:, None])[:, :, None] & (held < self.k[y][:, None])[:, None, :]
            same &= (p < 0) | (q < 0) | (p == q) | (self.length[x][:, None, None] - p == self.length[y][:, None, None] - q)
            first = same.any(axis=2).argmax(axis=1)
            out[at : at + (1 << 15)] = a[np.arange(len(x)), first] == self.list[x]
        return out

    def one_by_one(self, i: int, j: int) -> bool:
        """``merged``, ``near`` and ``first_shared`` of a pair with a long word."""
        a, b = self._tokens(i), self._tokens(j)
        if len(set(a) & set(b)) < max(len(a) - self.k[i], len(b) - self.k[j]) + 1 or not one_edit(self.words[i], self.words[j]):
            return False
        other = dict(zip(b[: self.k[j]], self.places[j].as_py(), strict=False))
        for token, p in zip(a[: self.k[i]], self.places[i].as_py(), strict=False):
            q = other.get(token)
            if q is not None and (p < 0 or q < 0 or p == q or self.length[i] - p == self.length[j] - q):
                return token == self.list[i]
        return False


def near_in_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each word of a list with near words in it: how many, and the best of them."""
    for batch in batches:
        if not batch.num_rows:
            continue
        all_of = Members(batch)
        order = sorted(range(len(all_of.words)), key=lambda x: (-int(all_of.n[x]), all_of.words[x]))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        count, best = np.zeros(len(order), np.int64), np.full(len(order), len(order), np.int64)
        for i, j in all_of.pairs():
            held = all_of.fits(i, j)
            i, j = i[held], j[held]
            both_short = all_of.short[i] & all_of.short[j]
            wide = [(x, y) for x, y in zip(i[~both_short].tolist(), j[~both_short].tolist(), strict=True) if all_of.one_by_one(x, y)]
            i, j = i[both_short], j[both_short]
            for test in (all_of.merged, all_of.near, all_of.first_shared):
                held = test(i, j)
                i, j = i[held], j[held]
            if wide:
                i, j = (np.concatenate((x, np.array(w, np.int64))) for x, w in zip((i, j), zip(*wide, strict=True), strict=True))
            for x, y in ((i, j), (j, i)):
                count += np.bincount(x, minlength=len(count))
                np.minimum.at(best, x, rank[y])
        found = np.flatnonzero(count)
        names = [all_of.words[order[r]] for r in best[found].tolist()]
        yield pa.record_batch(
            {
                "word": pa.array([all_of.words[x] for x in found.tolist()], pa.string()),
                "near": pa.array(count[found]),
                "best_n": pa.array(all_of.n[[order[r] for r in best[found].tolist()]], pa.int64()),
                "best": pa.array(names, pa.string()),
            }
        )


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, best_n, best: of each word with near words, how many and the most frequent one."""
    spread = materialise(
        in_tasks(words, _decomposed(frequent_grams(words)), "longest int, word string, n long, tokens array<long>, places array<int>, k int"),
        "word_grams",
    )
    entries = spread.select("*", F.posexplode(F.slice("tokens", F.lit(1), F.col("k"))).alias("i", "list"))
    sizes = entries.groupBy("longest", "list").agg(F.count("*").alias("size")).where(F.col("size") > 1)
    shared = sizes.select("longest", "list", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    dealt = entries.join(shared, ["longest", "list"]).withColumn("place", F.element_at("places", F.col("i") + 1))
    dealt = dealt.withColumn("part", F.pmod(F.hash("word"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    block = ["longest", "list", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high")]
    members = F.sort_array(F.collect_list(F.struct("part", "word", "n", "place", "k", "tokens", "places"))).alias("members")
    blocks = dealt.groupBy(*block).agg(members).where(F.size("members") > 1).select("longest", "list", "members")
    found = in_tasks(blocks, near_in_lists, "word string, near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("order"), "best", "best_n")).alias("best")
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best).select("word", "n_near", "best.best_n", "best.best")


def follow(forms: DataFrame) -> DataFrame:
    """word, root of each (word, form): forms followed to the last, by pointer doubling."""
    roots = materialise(forms.select("word", F.col("form").alias("root")), "word_roots")
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = roots.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        moved = materialise(moved, "word_roots")
        roots = moved.drop("moved")
        if not moved.where("moved").limit(1).count():
            return roots


def spelling_variants(words: DataFrame) -> DataFrame:
    """For each of the distinct ``words`` (word, n) of 5 code points and more: word, form, root, n, n_near, form_n."""
    words = materialise(words.where(F.length("word") >= MIN_LENGTH).select("word", "n"), "words")
    joined = words.join(near_words(words), "word", "left")
    holds = F.col("best_n") >= 2 * F.col("n")
    graded = materialise(
        joined.select(
            "word", F.when(holds, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(holds, F.col("best_n")).alias("form_n")
        ),
        "word_forms",
    )
    roots = follow(graded.where("form is not null"))
    return graded.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
