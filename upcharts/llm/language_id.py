"""Language identification by a bidirectional gated recurrent network over bytes.

Texts are read whole, in segments of ``SEGMENT`` bytes that run side by side through a
forward and a backward recurrence. Every position gets a probability for each language;
a document's probabilities are the mean over the positions of its letters. Gates and
states use the softsign x / (1 + |x|), which costs no exponential.

The network is trained in numpy by backpropagation through time, with Adam, on
``SAMPLE`` documents per language (those with the least hash of their doc_id) and
``EXCERPTS`` segments of each, spread over the whole text. Only text and lang of rows
whose crc32(doc_id as text) mod 5 is not 0 are learnt from; these bounds do not depend
on the input. Training is deterministic.

A null text or one without a letter is ``und`` with score 0, and so is every text if
nothing could be learnt. Rows without lang or doc_id are predicted but not learnt from.
Repeated rows count as often as they occur. Other columns are ignored. An empty table
gives an empty result.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upcharts.llm.ship import in_tasks
from upcharts.llm.text import text_slices

SEGMENT = 64
HIDDEN = 8
SAMPLE = 240
EXCERPTS = 8
EPOCHS = 5
BATCH = 192
LANES = 2048
RATE = 0.02
#: a document is rejected if its best language has under this multiple of an even share
MIN_LIFT = 1.1

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def _soft(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


@dataclass
class Direction:
    """One recurrence: byte table (256, 3H), state weights (H, 3H); order update, reset, new."""

    table: np.ndarray
    state: np.ndarray

    def forward(self, codes: np.ndarray, trace: list | None = None) -> np.ndarray:
        """States (steps, lanes, H) for byte codes (steps, lanes)."""
        h = np.zeros((codes.shape[1], HIDDEN), np.float32)
        out = np.empty((*codes.shape, HIDDEN), np.float32)
        for t in range(len(codes)):
            x = self.table[codes[t]]
            back = h @ self.state
            gates = _soft(x[:, : 2 * HIDDEN] + back[:, : 2 * HIDDEN])
            update, reset = 0.5 + 0.5 * gates[:, :HIDDEN], 0.5 + 0.5 * gates[:, HIDDEN:]
            new = _soft(x[:, 2 * HIDDEN :] + reset * back[:, 2 * HIDDEN :])
            if trace is not None:
                trace.append((h, gates, update, reset, new, back[:, 2 * HIDDEN :]))
            h = new + update * (h - new)
            out[t] = h
        return out

    def backward(self, codes: np.ndarray, trace: list, grad: np.ndarray) -> list[np.ndarray]:
        """Gradients of table and state from those of the states."""
        d_table, d_state = np.zeros_like(self.table), np.zeros_like(self.state)
        carry = np.zeros_like(grad[0])
        for t in reversed(range(len(codes))):
            h, gates, update, reset, new, back_new = trace[t]
            d_h = grad[t] + carry
            d_new = d_h * (1 - update) * (1 - np.abs(new)) ** 2
            slope = 0.5 * (1 - np.abs(gates)) ** 2
            d_update = d_h * (h - new) * slope[:, :HIDDEN]
            d_reset = d_new * back_new * slope[:, HIDDEN:]
            d_x = np.concatenate([d_update, d_reset, d_new], axis=1)
            d_back = np.concatenate([d_update, d_reset, d_new * reset], axis=1)
            np.add.at(d_table, codes[t], d_x)
            d_state += h.T @ d_back
            carry = d_h * update + d_back @ self.state.T
        return [d_table, d_state]


@dataclass
class Model:
    """The network and the names of its languages."""

    languages: list[str]
    front: Direction
    rear: Direction
    head: np.ndarray
    bias: np.ndarray

    @classmethod
    def fresh(cls, languages: list[str]) -> "Model":
        random = np.random.default_rng(5)
        draw = lambda *shape, scale: (random.standard_normal(shape) * scale).astype(np.float32)
        direction = lambda: Direction(draw(256, 3 * HIDDEN, scale=0.5), draw(HIDDEN, 3 * HIDDEN, scale=0.5))
        return cls(languages, direction(), direction(), draw(2 * HIDDEN, len(languages), scale=0.5), np.zeros(len(languages), np.float32))

    def parameters(self) -> list[np.ndarray]:
        return [self.front.table, self.front.state, self.rear.table, self.rear.state, self.head, self.bias]

    def _states(self, codes: np.ndarray, traces: tuple | None = None) -> np.ndarray:
        first, second = traces if traces else (None, None)
        a = self.front.forward(codes, first)
        b = self.rear.forward(codes[::-1], second)[::-1]
        return np.concatenate([a, b], axis=2)

    def positions(self, codes: np.ndarray) -> np.ndarray:
        """Probability of each language at each position: (steps, lanes, languages)."""
        return _softmax(self._states(codes) @ self.head + self.bias)

    def gradients(self, codes: np.ndarray, letters: np.ndarray, goal: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean cross-entropy over letters; goal is a language per lane."""
        traces = ([], [])
        states = self._states(codes, traces)
        wrong = _softmax(states @ self.head + self.bias)
        wrong[:, np.arange(len(goal)), goal] -= 1
        wrong *= (letters / max(1, letters.sum()))[:, :, None]
        flat = wrong.reshape(-1, wrong.shape[2])
        back = wrong @ self.head.T
        front = self.front.backward(codes, traces[0], back[:, :, :HIDDEN])
        rear = self.rear.backward(codes[::-1], traces[1], back[::-1, :, HIDDEN:])
        return [*front, *rear, states.reshape(-1, 2 * HIDDEN).T @ flat, flat.sum(0)]

    def pooled(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean probabilities over the letters of each text: (texts, languages)."""
        sizes = np.diff(offsets)
        parts = -(-sizes // SEGMENT)
        doc = np.repeat(np.arange(len(sizes)), parts)
        start = offsets[doc] + (np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)) * SEGMENT
        total, letters = np.zeros((len(sizes), len(self.languages))), np.zeros(len(sizes))
        for at in range(0, len(doc), LANES):
            own = doc[at : at + LANES]
            place = start[at : at + LANES][None, :] + np.arange(SEGMENT)[:, None]
            inside = place < offsets[own + 1][None, :]
            codes = np.where(inside, data[np.minimum(place, len(data) - 1)], 0)
            mask = _LETTER[codes] & inside
            mean = np.einsum("tlc,tl->lc", self.positions(codes), mask.astype(np.float32))
            np.add.at(total, own, mean)
            np.add.at(letters, own, mask.sum(0))
        return total / np.maximum(letters, 1)[:, None]


def _softmax(x: np.ndarray) -> np.ndarray:
    # states lie in (-1, 1), so logits stay far from overflow
    np.exp(x, out=x)
    x /= x.sum(axis=2, keepdims=True)
    return x


def fit(samples: list[tuple[str, list[bytes]]]) -> Model:
    """Train on (language, excerpts) pairs."""
    languages = sorted({lang for lang, _ in samples})
    model = Model.fresh(languages)
    rows = [(languages.index(lang), e) for lang, excerpts in samples for e in excerpts if e]
    if len(languages) < 2 or not rows:
        return model
    codes = np.zeros((len(rows), SEGMENT), np.uint8)
    for i, (_, e) in enumerate(rows):
        codes[i, : min(len(e), SEGMENT)] = np.frombuffer(e[:SEGMENT], np.uint8)
    goal = np.array([g for g, _ in rows])
    codes, letters = codes.T, _LETTER[codes.T].astype(np.float32)
    random = np.random.default_rng(7)
    weights = model.parameters()
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step = 0
    for _ in range(EPOCHS):
        order = random.permutation(len(rows))
        for at in range(0, len(rows), BATCH):
            own = order[at : at + BATCH]
            step += 1
            for w, g, m, v in zip(weights, model.gradients(codes[:, own], letters[:, own], goal[own]), first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
    return model


def training_samples(docs: DataFrame, sample: int = SAMPLE) -> list[tuple[str, list[bytes]]]:
    """Excerpts of at most ``sample`` documents of each language, drawn by hash of doc_id."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out())
    draw = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    # the rank limit applies before the shuffle as well as after it
    chosen = usable.select("lang", "doc_id").withColumn("draw", F.row_number().over(draw)).where(F.col("draw") <= sample)
    chosen = chosen.select("lang", "doc_id").distinct()
    room = F.greatest(F.char_length("text") - SEGMENT, F.lit(0))
    excerpts = [F.substring("text", (F.floor(room * k / (EXCERPTS - 1)) + 1).cast("int"), F.lit(SEGMENT)) for k in range(EXCERPTS)]
    # bounded by the sample times the languages
    rows = usable.join(F.broadcast(chosen), ["lang", "doc_id"]).select("lang", "doc_id", F.array_distinct(F.array(*excerpts)).alias("excerpts"))
    found = sorted((r["doc_id"], r["lang"], r["excerpts"]) for r in rows.collect())
    return [(lang, [e.encode()[:SEGMENT] for e in excerpts]) for _, lang, excerpts in found]


def _predict(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.languages, "und"])
        for batch in batches:
            for row, end, data, offsets in text_slices(batch.column("text")):
                spoken = batch.column("has_letter").slice(row, end - row).to_numpy(zero_copy_only=False)
                if model.languages:
                    mean = model.pooled(data, offsets)
                    best = mean.argmax(axis=1)
                    score = mean[np.arange(len(best)), best]
                else:
                    spoken = np.zeros(end - row, bool)
                    best, score = np.zeros(end - row, np.int64), np.zeros(end - row)
                best = np.where(spoken, best, len(names) - 1)
                columns = {c: batch.column(c).slice(row, end - row) for c in batch.schema.names if c not in ("text", "has_letter")}
                lang = pa.array(names[best].tolist(), pa.string())
                yield pa.record_batch(columns | {"lang_pred": lang, "score": pa.array(np.where(spoken, np.clip(score, 0, 1), 0.0))})

    return run


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    return fit(training_samples(docs, sample))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("has_letter")
    rows = docs.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "text", letters)
    return in_tasks(rows, _predict(model), "doc_id long, held_out boolean, lang_pred string, score double")


def _spoken(model: Model, min_lift: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for row, end, data, offsets in text_slices(batch.column("text")):
                part = batch.column("text").slice(row, end - row)
                spoken = np.array([t is not None and any(map(str.isalpha, t)) for t in part.to_pylist()], bool)
                if model.languages:
                    spoken &= model.pooled(data, offsets).max(axis=1) * len(model.languages) >= min(min_lift, len(model.languages))
                keep.append(spoken)
            yield batch.filter(pa.array(np.concatenate(keep) if keep else [], pa.bool_()))

    return run


def drop_unidentified(docs: DataFrame, model: Model, min_lift: float = MIN_LIFT) -> DataFrame:
    """The rows of ``docs`` in a language: not ``und``, and one language stands out by ``min_lift``.

    Mixed and short documents stay. At the default almost only ``und`` goes: the largest of
    k probabilities is never below 1/k, so junk with letters and unlearnt languages pass.
    """
    return in_tasks(docs, _spoken(model, min_lift), docs.schema)
