"""Spelling variants against a plain search, lists cut into blocks, and the bounds of the gram index."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm import messy
from tests.llm.messy import LOWER, in_order
from upcharts.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def counted(rows):
    counts = Counter()
    for d, text in rows:
        for run in RUN.findall((text or "").translate(LOWER)):
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def brute(counts):
    wild, near = defaultdict(set), defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            wild[w[:i], w[i + 1 :]].add(w)
            if (short := w[:i] + w[i + 1 :]) in counts:
                near[w].add(short)
                near[short].add(w)
    for words in wild.values():
        for w in words:
            near[w] |= words - {w}
    best = {w: min(near[w], key=lambda x: (-counts[x], x)) for w in counts if near[w]}
    form = {w: b for w, b in best.items() if counts[b] >= 2 * counts[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return in_order((w, form.get(w), root(w), n, len(near[w]), counts.get(form.get(w))) for w, n in counts.items())


def misspellings(seed: int, words: int) -> dict[str, int]:
    """Words of few syllables and long ones, with edits at every place, repeated grams and chains of forms."""
    random = np.random.default_rng(seed)
    letters = list("abcdetionéÿ")
    out: dict[str, int] = {"aaaaa": 4, "aaaaaa": 9, "aaaaaaa": 30, "ababab": 3, "abababa": 7, "bababa": 8}
    for _ in range(words):
        word = "".join(random.choice(["tion", "er", "ent", "de", "ab", "é", "ÿo"], random.integers(2, 5)))
        if random.random() < 0.1:
            word = "".join(random.choice(letters, random.integers(40, 70)))
        for _ in range(random.integers(1, 6)):
            if len(word) >= 5:
                out[word] = int(random.integers(3, 200))
            at, kind = int(random.integers(len(word) + 1)), random.integers(3)
            word = word[:at] + (random.choice(letters) if kind else "") + word[at + (kind != 1) :]
    return {str(w): n for w, n in out.items() if len(w) >= 5}


@pytest.mark.parametrize(("block", "frequent"), [(spelling.BLOCK, spelling.LIST), (7, 10)])
def test_variants_of_planted_misspellings(spark, monkeypatch, block, frequent):
    monkeypatch.setattr(spelling, "BLOCK", block)
    monkeypatch.setattr(spelling, "LIST", frequent)
    counts = misspellings(11, 500)
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    got = in_order(spelling.spelling_variants(words).collect())
    assert got == brute(counts) and sum(r[4] > 0 for r in got) > 200


def test_counts_of_awkward_rows(spark):
    rows = [(*r, 1, 2, "x", 3, 4, 5, 6) for r in messy.messy_rows()]
    rows += [(None, "Ünïted ünïted UNITED ×÷×÷× straße naïveté", *rows[0][2:]), (3, "naïveté naïveté naïvetés " * 40, *rows[0][2:])]
    docs = spark.createDataFrame(rows, messy.CLASHING)
    found = spelling.word_counts(spelling.misspelt(spelling.runs(docs)))
    assert {r["word"]: r["n"] for r in found.collect()} == counted([r[:2] for r in rows])


def test_no_rows(spark):
    empty = spark.createDataFrame([], messy.SCHEMA)
    assert spelling.spelling_variants(spelling.word_counts(spelling.runs(empty))).collect() == []


def test_near_words_meet_in_the_lists_the_bounds_leave():
    random = np.random.default_rng(3)
    frequent = {g: 100 for g in ("ti", "tio", "ion", "io", "en", "ent", "de", "ab", "aba", "abab", "er", "n\n")}
    for _ in range(3000):
        word = "".join(random.choice(["tion", "ent", "de", "ab", "er", "x", "é"], random.integers(3, 7)))
        if len(word) < 5:
            continue
        at, kind = int(random.integers(len(word) + 1)), random.integers(3)
        other = word[:at] + (random.choice(list("abtioz")) if kind else "") + word[at + (kind != 1) :]
        if len(other) < 5 or not spelling.one_edit(word, other):
            continue
        longest = spelling.longest_gram(min(len(word), len(other)))
        (a, _, k), (b, _, m) = (spelling.indexed(w, longest, frequent) for w in (word, other))
        assert len(set(a) & set(b)) >= max(len(a) - k, len(b) - m) + 1 >= 1
        assert set(a[:k]) & set(b[:m])
