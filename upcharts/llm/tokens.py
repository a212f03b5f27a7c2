"""Token ids of whole texts, by a public tokenizer file, inside Arrow tasks.

The vocabulary drops white space, and no token or normalization reaches across it, so
a text's ids are those of its white-space separated pieces in order. Pieces repeat a
lot; each worker encodes a piece once and keeps its ids in a table of bounded size.
Pieces that are ASCII letters with punctuation behind share the ids of the bare
lower-case letters. ``tests/llm`` holds the result against encoding whole texts.
"""

import os
import re

import numpy as np

from upcharts.llm.text import Words, words_of

END = 1
VOCABULARY = "word_bpe_49k.json"
# distinct pieces, and distinct units of pieces, a worker remembers; beyond that it starts over
REMEMBERED = 1_000_000
LONGEST = 64
# bytes of text encoded at a time; pieces are looked up once in each
SLICE = 2 << 20

_LETTERS = re.compile(rb"([A-Za-z]+)([!-&(-/:-@\[-`{-~]*)")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of texts by the tokenizer file ``name``; ``path`` overrides where it lies."""

    def __init__(self, name: str = VOCABULARY, path: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or vocabulary_path(name))
        self._forget()

    def _forget(self) -> None:
        # a piece is one or two units (letters, punctuation); unit 0 has no ids
        self.units: dict[bytes, int] = {b"": 0}
        self.ids = np.empty(1 << 20, np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32)
        self.starts = np.zeros(1 << 18, np.int64)  # unit i owns ids starts[i]:starts[i+1]
        self.count = 1
        # known pieces by hash, ascending: their marks and codes; the last entry fits no piece
        self.hashes, self.marks, self.codes = np.full(1, ~np.uint64(0)), np.full(1, -1), np.zeros(1, np.int64)

    def _encode(self, pieces: list[bytes]) -> None:
        """Append the ids of pieces free of ASCII white space as new units."""
        for at in range(0, len(pieces), 1024):
            part = [p.decode() for p in pieces[at : at + 1024]]
            encoded = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1)
            begins = np.fromiter((o[0] for o in encoded.offsets), np.int64)
            bounds = self.starts[self.count] + np.searchsorted(begins, ends)
            if bounds[-1] > len(self.ids):
                self.ids = np.concatenate([self.ids, np.empty(max(len(self.ids), int(bounds[-1])), self.ids.dtype)])
            self.ids[self.starts[self.count] : bounds[-1]] = encoded.ids
            if self.count + len(part) + 1 > len(self.starts):
                self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.starts[self.count + 1 : self.count + len(part) + 1] = bounds
            self.count += len(part)

    def _add(self, pieces: list[bytes]) -> np.ndarray:
        """Codes of the pieces: the unit of the letters, and above it that of the punctuation."""
        units, fresh, parts = self.units, [], []
        for p in pieces:
            found = _LETTERS.fullmatch(p) if len(p) <= LONGEST else None
            pair = (found[1].lower(), found[2]) if found else (p, b"")
            parts.append(pair)
            for x in pair:
                if x not in units:
                    units[x] = self.count + len(fresh)
                    fresh.append(x)
        self._encode(fresh)
        return np.fromiter((units[a] | units[b] << 32 for a, b in parts), np.int64, len(parts))

    def _look_up(self, data: np.ndarray, words: Words) -> tuple[np.ndarray, list[bytes]]:
        """The code of each word, and the long pieces among them, which are not kept.

        A known piece is told by its hash of 64 bits, its length, and its first and last byte.
        """
        lengths = words.ends - words.starts
        marks = lengths << 16 | data[words.starts].astype(np.int64) << 8 | data[words.ends - 1]
        kinds, first, place = np.unique(words.hashes, return_index=True, return_inverse=True)
        alike = bool((marks == marks[first][place]).all())
        if not alike:
            # different words with one hash: each word is encoded by itself, and none is kept
            kinds, first = words.hashes, np.arange(len(marks))
            place = first
        at = np.searchsorted(self.hashes, kinds)
        same = self.hashes[at] == kinds
        known = same & (self.marks[at] == marks[first]) & alike
        codes = np.empty(len(first), np.int64)
        codes[known] = self.codes[at[known]]
        short = lengths[first] <= LONGEST
        raw = data.tobytes()
        taken = lambda which: [raw[a:b] for a, b in zip(words.starts[first[which]].tolist(), words.ends[first[which]].tolist(), strict=True)]
        codes[short & ~known] = self._add(taken(short & ~known))
        self.kept = self.count
        long = taken(~short)
        codes[~short] = self._add(long)
        new = short & ~same & alike
        self.hashes = np.insert(self.hashes, at[new], kinds[new])
        self.marks = np.insert(self.marks, at[new], marks[first[new]])
        self.codes = np.insert(self.codes, at[new], codes[new])
        return codes[place], long

    def encode(self, data: np.ndarray, offsets: np.ndarray, end: int | None = END) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts ``data[offsets[i]:offsets[i+1]]`` in a row, and the bounds of each text's."""
        if max(self.count, len(self.hashes)) > REMEMBERED:
            self._forget()
        data = data[int(offsets[0]) : int(offsets[-1])]
        words = words_of(data, offsets - offsets[0])
        codes, long = self._look_up(data, words)
        units = np.stack([codes & 0xFFFFFFFF, codes >> 32], axis=1).ravel()
        first = self.starts[units]
        lengths = self.starts[units + 1] - first
        before = np.concatenate([[0], np.cumsum(lengths)])
        tail = 0 if end is None else 1
        bounds = before[words.bounds * 2] + np.arange(len(offsets)) * tail
        total = int(before[-1])
        place = np.arange(total) + np.repeat(first - before[:-1], lengths)
        out = np.full(int(bounds[-1]), end or 0, np.uint32)
        spot = np.ones(len(out), bool)
        if tail:
            spot[bounds[1:] - 1] = False
        out[spot] = self.ids[place]
        for p in long:
            self.units.pop(p, None)
        self.count = self.kept
        return out, bounds


_encoders: dict[tuple, Encoder] = {}


def encoder(name: str = VOCABULARY, path: str | None = None) -> Encoder:
    """The worker's own encoder, kept from task to task."""
    if (name, path) not in _encoders:
        _encoders[name, path] = Encoder(name, path)
    return _encoders[name, path]
