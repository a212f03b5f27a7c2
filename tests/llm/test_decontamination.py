"""The error budget of decontamination, against plain edit distance."""

import numpy as np

from upcharts.llm.decontamination import SHORT, Matcher, budget, comparable, myers

WORDS = "river mountain seven before northern reaches others spring winter teacher garden answer".split()


def test_a_replaced_word_is_found_in_items_of_any_length():
    random = np.random.default_rng(5)
    for count in (8, 10, 14, 18, 40):
        words = list(random.choice(WORDS, count))
        item = " ".join(words)
        for at in range(count):
            edited = [*words[:at], "kitchen", *words[at + 1 :]]
            text = f"something ahead {' '.join(edited)} and behind"
            assert [f[0] for f in Matcher([(7, item.encode())]).find(text)] == [7], (item, at)


def test_short_items_match_exactly_as_words():
    matcher = Matcher([(1, b"blue whale"), (2, b"x"), (3, b"")])
    assert [f[:2] for f in matcher.find("The BLUE, whale.")] == [(1, 0)]
    assert matcher.find("blue whales") == [] and matcher.find("blue wale") == []
    assert [f[0] for f in matcher.find("x, blue whale")] == [1, 2]


def test_no_passage_within_the_budget_is_missed():
    random = np.random.default_rng(6)
    for _ in range(300):
        size = int(random.integers(SHORT, 130))
        item = bytes(random.choice(list(b"abcd "), size).tolist())
        item = comparable(item.decode())
        changed = bytearray(item)
        for _ in range(int(random.integers(0, 12))):
            at = int(random.integers(0, len(changed)))
            kind = random.integers(0, 3)
            if kind:
                changed[at : at + 1] = b"e" if kind == 1 else b""
            else:
                changed[at:at] = b"e"
        text = comparable(f"zz {changed.decode()} yy")
        distance = myers(item, text)[0]
        found = Matcher([(1, item)]).find(text.decode())
        if len(item) >= SHORT:
            assert [f[1] for f in found] == ([distance] if distance <= budget(len(item)) else [])
