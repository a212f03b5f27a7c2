"""A small table with the awkward cases, and brute-force versions of the operators."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# columns with names that operators use inside
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, block int, digest string, path string"
CLASHING = f"{SCHEMA}, _id long, _check long, _digest string, _gone int, _keep long, rep long, row long"


def messy_rows() -> list[tuple]:
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abdeghilmnorstu"), rng.integers(1, 9))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choice(words, n))

    passage, base = prose(60), prose(200).split(" ")
    texts = [None, "", "   ", "\n\n", "Hello", "hello", "HELLO", "ÉCOLE école", "123 456 $$$", "x" * 5000]
    texts += [prose(rng.integers(3, 80)) for _ in range(30)]
    texts += [prose(20) + " " + passage + "\n" + prose(15) for _ in range(4)] + [passage]
    texts += [" ".join(base)] * 3 + [" ".join(base).upper(), "\t".join(base)]
    for k in range(6):
        near = list(base)
        near[20 + k] = f"changed{k}"
        texts.append(" ".join(near))
    far = list(base)
    far[::9] = ["other"] * len(far[::9])
    texts.append(" ".join(far))
    texts += ["la la la " * 40, "one two three", "One two  three", "one two", "a b c d", "<|endoftext|> it's Á ẖ İ 東京 🙂"]
    texts.append(" ".join(prose(9000).split(" ")))
    texts += ["the quick brown fox jumps over it\r\nline two", "the quick brown fox jumps over them\r\nline two"]
    rows = [(i * 3 % 211, t, "en", "s", 1, 7, "d", "p") for i, t in enumerate(texts)]
    rows.append(rows[12])  # a repeated row
    rows += [(None, "null id text here now", None, None, None, None, None, None)]
    return rows


def words_of(text) -> list[str]:
    return WORDS.findall(text or "")


def brute_exact(rows):
    body = [(d, (t or "").translate(LOWER)) for d, t in rows]
    groups = defaultdict(list)
    for d, b in body:
        groups[b].append(d)
    out = []
    for d, b in body:
        keep = max((x for x in groups[b] if x is not None), default=None)
        out.append((d, keep, len(groups[b]), d == keep, hashlib.sha256(b.encode()).hexdigest()))
    return out


def brute_repeats(rows, window=35):
    texts = [words_of(t) for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(rows, texts, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def shingles(text, k=4):
    w = words_of((text or "").translate(LOWER))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute_near(rows, k=4, percent=80):
    low = -(1 << 63)
    sets = [(low if d is None else d, shingles(t, k)) for d, t in rows]
    parent = {d: d for d, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (d, a) in enumerate(sets):
        for e, b in sets[:i]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(d), find(e)
                parent[max(x, y)] = min(x, y)
    name = lambda x: None if x == low else x
    return [(name(d), len(s), name(find(d)), find(d) == d) for d, s in sets]


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=repr)
