"""Toxicity scores of deobfuscated text: noisy channel, Viterbi decoding, linear score.

1. A character trigram model is counted over all documents (26 letters, one symbol for
   other letters, one for a boundary).
2. Stretches that look obfuscated are decoded: letters with a digit or sign that stands
   for a letter on either side, doubled letters, three single letters or more with any
   run of other characters between them. Such a stretch becomes a lattice: each run of a
   character may be read as the letters it can stand for, once or twice, or as a
   boundary, and separators may vanish (between single letters, all that is no letter or
   digit); each reading has a channel cost. Viterbi finds the best path
   under trigram model and costs. Everywhere else the lattice has one path, the text.
3. Features are the whole words of the restored text (and of the stretches it changed, as
   they were: a plain word with a doubled letter may be read as another), and the runs of ``GRAMS``
   characters at every place inside a word, so that a word in a compound or in unspaced
   script is met as well; a document has a feature or not. The ``FEATURES`` that most
   surely are commoner under label 1 are weighed by logistic regression.

Labels are learnt from at most ``SAMPLE`` rows of each label value, those with the least
hash of doc_id among rows whose crc32(doc_id as text) mod 5 is not 0; weights restore
the true share of the labels. Model counts and scores cover all documents whole.

Null and empty texts get the score of a text without features. Without labels of both
kinds the score is the share of label 1 (0 if there is none). Rows with a null doc_id or
label are not learnt from; repeated label rows count once each. Other columns are
ignored. An empty table gives an empty result.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upcharts.llm.ship import in_tasks
from upcharts.llm.text import mix, run_hashes, signed, text_slices, words_of
from upcharts.session import materialise

SAMPLE = 10_000
FEATURES = 256
GRAMS = (2, 3, 4, 5)
SYMBOLS = 28
OTHER = 27

# readings of signs that stand for letters
LEET = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t",
}
SEPARATORS = " .-_*'"
# channel costs, as log probabilities
SUBSTITUTED, DOUBLED, VANISHED, SEPARATED, UNREAD, SHORTENED = -1.0, -2.0, -0.5, -1.5, -8.0, -1.0

# single letters with anything but letters and digits between them
_CHAIN = re.compile(r"(?<![^\W_])[^\W\d_](?:[\W_]+[^\W\d_](?![^\W_])){2,}")

_CODE = np.zeros(256, np.int64)
for _c in range(26):
    _CODE[97 + _c] = _CODE[65 + _c] = _c + 1
_CODE[128:] = OTHER
_FOLD = np.full(256, 32, np.uint8)
for _c in range(256):
    if _CODE[_c]:
        _FOLD[_c] = _c + 32 if 65 <= _c <= 90 else _c
_LETTER = _CODE > 0
_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in LEET]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_BREAK = np.zeros(256, bool)
_BREAK[[0x20, *range(0x09, 0x0E)]] = True


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


# --- character model ---------------------------------------------------------------


def _trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram counts of a task's whole texts; boundaries pad each text."""
    counts = np.zeros(SYMBOLS**3, np.int64)
    for batch in batches:
        for _, _, data, offsets in text_slices(batch.column("text")):
            codes = _CODE[data[offsets[0] : offsets[-1]]]
            # two boundaries before each text and one behind it
            at = np.arange(len(codes)) + np.repeat(np.arange(len(offsets) - 1) * 3 + 2, np.diff(offsets))
            padded = np.zeros(len(codes) + 3 * (len(offsets) - 1), np.int64)
            padded[at] = codes
            if len(padded) > 2:
                gram = (padded[:-2] * SYMBOLS + padded[1:-1]) * SYMBOLS + padded[2:]
                counts += np.bincount(gram, minlength=len(counts))
    there = np.flatnonzero(counts)
    yield pa.record_batch({"gram": pa.array(there), "n": pa.array(counts[there])})


def character_model(docs: DataFrame) -> np.ndarray:
    """Log probabilities (28, 28, 28) of a symbol behind two others, over all documents."""
    counted = in_tasks(docs.select("text"), _trigrams, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    counts = np.full(SYMBOLS**3, 0.1)
    for row in counted.collect():  # at most 28^3 rows
        counts[row["gram"]] += row["n"]
    counts = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    return np.log(counts / counts.sum(axis=2, keepdims=True))


# --- decoding ----------------------------------------------------------------------


def _readings(char: str, run: int, spaced: bool = False, last: bool = False) -> list[tuple[str, float]]:
    """What a run of one character may stand for, with channel costs.

    ``spaced``: it stands between single letters; ``last``: it ends the stretch.
    """
    if char.isalpha():
        if run == 1:
            return [(char, 0.0)]
        if run == 2:
            return [(char * 2, 0.0), (char, DOUBLED)]
        return [(char, SHORTENED), (char * 2, SHORTENED)]
    # an exclamation mark at the end is punctuation first
    out = [(" ", UNREAD if char in LEET and not (last and char == "!") else SEPARATED)]
    for letter in LEET.get(char, ""):
        out.append((letter, SUBSTITUTED))
        if run > 1:
            out.append((letter * 2, SUBSTITUTED))
    if char in SEPARATORS or spaced:
        out.append(("", VANISHED))
    return out


def _symbol(char: str) -> int:
    if "a" <= char <= "z":
        return ord(char) - 96
    return OTHER if char.isalpha() else 0


@lru_cache(1 << 14)
def _coded(char: str, run: int, spaced: bool, last: bool) -> list[tuple[str, list[int], float]]:
    """Readings with their symbols; runs of three and more read alike."""
    return [(reading, [_symbol(c) for c in reading], cost) for reading, cost in _readings(char, run, spaced, last)]


def decode(stretch: str, model: list) -> str:
    """The best reading of an obfuscated stretch, in lower case; ``model`` as nested lists.

    A path is its last reading with a pointer to the path before it, so a step costs the
    same wherever in the stretch it is.
    """
    paths: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    low = stretch.lower()
    chains = iter([m.span() for m in _CHAIN.finditer(low)])
    begin, end = next(chains, (len(low), len(low)))
    for m in re.finditer(r"(.)\1*", low, re.S):
        char, run = m[1], len(m[0])
        while m.start() >= end and end < len(low):
            begin, end = next(chains, (len(low), len(low)))
        spaced = begin < m.start() < end and not char.isalnum()
        readings = _coded(char, min(run, 3), spaced, m.end() == len(low))
        nearer: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (score, path) in paths.items():
            for reading, codes, cost in readings:
                x, y, total = a, b, score + cost
                for z in codes:
                    total += model[x][y][z]
                    x, y = y, z
                if (x, y) not in nearer or nearer[x, y][0] < total:
                    nearer[x, y] = (total, (path, reading))
        paths = nearer
    ends = [(score + model[a][b][0], path) for (a, b), (score, path) in paths.items()]
    best = max(score for score, _ in ends)
    return max(_text_of(path) for score, path in ends if score == best)


def _text_of(path: tuple | None) -> str:
    readings = []
    while path is not None:
        path, reading = path
        readings.append(reading)
    return "".join(reversed(readings))


def suspicious(data: np.ndarray) -> list[tuple[int, int]]:
    """Byte ranges of stretches to decode."""
    n = len(data)
    if n < 3:
        return []
    letter, sign = _LETTER[data], _SIGN[data]
    mark = np.zeros(n, bool)
    # a sign or digit on either side of a letter
    mark[:-1] |= sign[:-1] & letter[1:]
    mark[1:] |= (sign[1:] | _DIGIT[data[1:]]) & letter[:-1]
    # two equal letters
    low = _FOLD[data]
    mark[1:] |= (low[1:] == low[:-1]) & letter[1:] & (data[1:] < 128)
    solid = ~_BREAK[data]
    edge = np.diff(np.concatenate([[False], solid, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    marks = np.concatenate([[0], np.cumsum(mark)])
    has = marks[ends] > marks[starts]
    # signs alone, numbers and addresses have no letters to speak of
    letters = np.concatenate([[0], np.cumsum(letter)])
    has &= letters[ends] - letters[starts] >= 1
    spans = list(zip(starts[has].tolist(), ends[has].tolist(), strict=True))
    if n >= 5:
        # three letters or more, each alone, with no other letter or digit between them
        full = letter | _DIGIT[data]
        alone = letter.copy()
        alone[1:] &= ~full[:-1]
        alone[:-1] &= ~full[1:]
        at = np.flatnonzero(alone)
        linked = np.diff(np.cumsum(full)[at]) == 1
        edge = np.diff(np.concatenate([[False], linked, [False]]).astype(np.int8))
        for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
            if b - a > 1:
                spans.append((int(at[a]), int(at[b]) + 1))
    if not spans:
        return []
    spans.sort()
    merged = [spans[0]]
    for a, b in spans[1:]:
        if a < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


class Restorer:
    """Restores texts, remembering decoded stretches up to a bound."""

    def __init__(self, model: np.ndarray, remembered: int = 200_000):
        self.model, self.remembered, self.known = model.tolist(), remembered, {}

    def _decode(self, raw: bytes) -> bytes:
        if len(raw) > 64:
            return decode(raw.decode(errors="replace"), self.model).encode()
        if raw not in self.known:
            if len(self.known) >= self.remembered:
                self.known.clear()
            self.known[raw] = decode(raw.decode(errors="replace"), self.model).encode()
        return self.known[raw]

    def texts(self, data: np.ndarray, offsets: np.ndarray, given: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and offsets of the restored texts; ``given``: with the stretches that changed, as they were, behind each."""
        parts, bounds = [], [0]
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            own = data[a:b]
            at, pieces, changed = 0, [], []
            for low, high in suspicious(own):
                pieces.append(own[at:low])
                raw = own[low:high].tobytes()
                restored = self._decode(raw)
                pieces.append(np.frombuffer(restored, np.uint8))
                if given and restored != raw.lower():
                    changed += [b" ", raw]
                at = high
            pieces.append(own[at:])
            if changed:
                pieces.append(np.frombuffer(b"".join(changed), np.uint8))
            parts += pieces
            bounds.append(bounds[-1] + sum(map(len, pieces)))
        return (np.concatenate(parts) if parts else np.empty(0, np.uint8)), np.array(bounds, np.int64)


# --- features ----------------------------------------------------------------------


def _distinct_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, distinct word) of each word, the distinct words' hashes, and their characters.

    Characters are hashed one by one; they come with the distinct words' sizes.
    """
    low = _FOLD[data]
    solid = low != 32
    cut = np.zeros(len(low) + 1, bool)
    cut[offsets] = True
    first = solid.copy()
    first[1:] &= ~solid[:-1] | cut[1:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:] | cut[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    doc = np.searchsorted(offsets, starts, "right") - 1
    hashes, one, word = np.unique(words_of(low, offsets).hashes, return_index=True, return_inverse=True)
    starts, size = starts[one], ends[one] - starts[one]
    # the bytes of the distinct words behind one another
    begin = np.cumsum(size) - size
    at = np.arange(int(size.sum())) + np.repeat(starts - begin, size)
    text = low[at]
    # a character begins at every byte but 80-BF, and at each word's first
    head = (text & 0xC0) != 0x80
    head[begin] = True
    at = np.flatnonzero(head)
    after = np.append(at[1:], len(text))
    padded = np.append(text, np.zeros(3, np.uint8)).astype(np.uint32)
    value = padded[at]
    for k in (1, 2, 3):
        value |= np.where(at + k < after, padded[at + k], np.uint32(0)) << np.uint32(8 * k)
    owner = np.repeat(np.arange(len(size)), size)[at]
    return doc, word, mix(hashes), mix(value.astype(np.uint64)), np.bincount(owner, minlength=len(size))


def _word_runs(hashes: np.ndarray, char: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word, feature) of distinct words: the words themselves, then each length of run."""
    yield np.arange(len(hashes)), hashes
    owner = np.repeat(np.arange(len(size)), size)
    for n in GRAMS:
        runs = run_hashes(char, n, seed=n)
        fits = owner[: len(runs)] == owner[n - 1 :]
        yield owner[: len(runs)][fits], runs[fits]


def _joined(parts: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    words, features = zip(*parts, strict=True)
    return np.concatenate(words), np.concatenate(features)


def _expanded(doc: np.ndarray, word: np.ndarray, owner: np.ndarray, place: np.ndarray, kinds: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, place), each once, where word ``owner[i]`` has the feature at ``place[i]`` of ``kinds``."""
    order = np.argsort(owner, kind="stable")
    owner, place = owner[order], place[order]
    words = int(word.max()) + 1 if len(word) else 0
    both = np.unique(doc * words + word) if words else np.empty(0, np.int64)
    doc, word = (both // words, both % words) if words else (both, both)
    low, high = np.searchsorted(owner, word, "left"), np.searchsorted(owner, word, "right")
    many = high - low
    at = np.arange(int(many.sum())) + np.repeat(low - (np.cumsum(many) - many), many)
    both = np.unique(np.repeat(doc, many) * kinds + place[at])
    return both // kinds, both % kinds


def word_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature), each once, of all words and of the runs of ``GRAMS`` characters inside them.

    Lengths count characters, not bytes; a whole word and a run of the same characters differ.
    """
    doc, word, *kept = _distinct_words(data, offsets)
    owner, feature = _joined(_word_runs(*kept))
    kinds, place = np.unique(feature, return_inverse=True)
    if not len(kinds):
        return np.empty(0, np.int64), kinds
    doc, place = _expanded(doc, word, owner, place, len(kinds))
    return doc, kinds[place]


def _label_counts(model: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model)
        for batch in batches:
            label = batch.column("toxic").to_numpy()
            for row, end, data, offsets in text_slices(batch.column("text")):
                doc, feature = word_features(*restorer.texts(data, offsets, given=True))
                toxic = label[row:end][doc]
                kinds, place = np.unique(feature, return_inverse=True)
                yield pa.record_batch(
                    {
                        "feature": signed(kinds),
                        "bad": pa.array(np.bincount(place, toxic, len(kinds)).astype(np.int64)),
                        "good": pa.array(np.bincount(place, 1 - toxic, len(kinds)).astype(np.int64)),
                    }
                )

    return run


def _presence(restorer: Restorer, chosen: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, place in ``chosen``) of the chosen features of each text, each once."""
    doc, word, *kept = _distinct_words(*restorer.texts(data, offsets, given=True))
    # most features fail a look at 16 of their bits
    maybe = np.zeros(1 << 16, bool)
    maybe[chosen & np.uint64(0xFFFF)] = True
    owners, places = [], []
    for owner, feature in _word_runs(*kept):
        near = np.flatnonzero(maybe[feature & np.uint64(0xFFFF)])
        owner, feature = owner[near], feature[near]
        at = np.minimum(np.searchsorted(chosen, feature), len(chosen) - 1)
        found = chosen[at] == feature
        owners.append(owner[found])
        places.append(at[found])
    return _expanded(doc, word, np.concatenate(owners), np.concatenate(places), len(chosen))


def _sample_presence(model: np.ndarray, chosen: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model)
        for batch in batches:
            for row, end, data, offsets in text_slices(batch.column("text")):
                doc, place = _presence(restorer, chosen, data, offsets)
                bounds = np.searchsorted(doc, np.arange(end - row + 1)).astype(np.int32)
                yield pa.record_batch(
                    {
                        "toxic": batch.column("toxic").slice(row, end - row),
                        "places": pa.ListArray.from_arrays(pa.array(bounds), pa.array(place.astype(np.int32))),
                    }
                )

    return run


# --- classifier --------------------------------------------------------------------


@dataclass
class Scorer:
    model: np.ndarray
    chosen: np.ndarray
    weights: np.ndarray
    bias: float


def _logistic(rows: list[tuple[int, list[int]]], width: int, share: dict[int, float]) -> tuple[np.ndarray, float]:
    """Weights by Newton's method with a ridge; rows weigh what their label's sample stands for."""
    x = np.zeros((len(rows), width + 1))
    x[:, width] = 1
    for i, (_, places) in enumerate(rows):
        x[i, places] = 1
    y = np.array([r[0] for r in rows], float)
    weight = np.array([share[r[0]] for r in rows])
    weight *= len(rows) / weight.sum()
    ridge = np.full(width + 1, 1.0)
    ridge[width] = 1e-3
    w = np.zeros(width + 1)
    for _ in range(12):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = weight * p * (1 - p)
        gradient = x.T @ (weight * (y - p)) - ridge * w
        move = np.linalg.solve((x * slope[:, None]).T @ x + np.diag(ridge), gradient)
        w += move
        if np.abs(move).max() < 1e-4:
            break
    return w[:width], float(w[width])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, features: int = FEATURES) -> Scorer:
    """Model, chosen features and weights; what reaches the driver is bounded by the parameters."""
    model = character_model(docs)
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()).select("doc_id", F.col("toxic").cast("long"))
    totals = {r["toxic"]: r["n"] for r in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    none = np.empty(0, np.uint64), np.empty(0)
    if len(totals) < 2:
        prior = float(bool(totals.get(1)))
        return Scorer(model, *none, 30.0 if prior else -30.0)
    draw = [usable.where(F.col("toxic") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for v in (0, 1)]
    drawn = F.broadcast(draw[0].unionByName(draw[1]))  # at most twice ``sample`` rows
    rows = materialise(docs.select("doc_id", "text").join(drawn, "doc_id").select("toxic", "text"), "labelled")
    counted = in_tasks(rows, _label_counts(model), "feature long, bad long, good long").groupBy("feature")
    counted = counted.agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    seen = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(seen) < 2:
        prior = totals[1] / (totals[0] + totals[1])
        return Scorer(model, *none, float(np.log(prior / (1 - prior))))
    p, q = (F.col("bad") + 0.5) / (seen[1] + 1), (F.col("good") + 0.5) / (seen[0] + 1)
    spread = F.sqrt(p * (1 - p) / seen[1] + q * (1 - q) / seen[0] + 1e-12)
    best = counted.orderBy(F.desc((p - q) / spread), "feature").limit(features).select("feature").collect()
    chosen = np.sort(np.array([r["feature"] for r in best], np.int64).view(np.uint64))
    if not len(chosen):
        return Scorer(model, *none, float(np.log(totals[1] / totals[0])))
    found = in_tasks(rows, _sample_presence(model, chosen), "toxic long, places array<int>").collect()
    share = {v: totals[v] / seen[v] for v in (0, 1)}
    weights, bias = _logistic(sorted((r["toxic"], list(r["places"])) for r in found), len(chosen), share)
    return Scorer(model, chosen, weights, bias)


def _scored(scorer: Scorer):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(scorer.model)
        for batch in batches:
            for row, end, data, offsets in text_slices(batch.column("text")):
                total = np.full(end - row, scorer.bias)
                if len(scorer.chosen):
                    doc, place = _presence(restorer, scorer.chosen, data, offsets)
                    np.add.at(total, doc, scorer.weights[place])
                score = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
                yield pa.record_batch(
                    {
                        "doc_id": batch.column("doc_id").slice(row, end - row),
                        "held_out": batch.column("held_out").slice(row, end - row),
                        "score": pa.array(score),
                        "predicted": pa.array((score >= 0.5).astype(np.int32)),
                    }
                )

    return run


def score(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    rows = docs.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "text")
    return in_tasks(rows, _scored(scorer), "doc_id long, held_out boolean, score double, predicted int")
