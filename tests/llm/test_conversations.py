"""Conversation repair against a plain search over all edits, in chunks of any size."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tests.llm.messy import in_order
from upcharts.llm import conversations
from upcharts.llm.conversations import Costs

SCHEMA = "conv_id long, turn long, role string, text string"
MESSY = SCHEMA + ", row long, chunk long, part int, h long, symbol int, place int, made string"
NEXT = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}


def damaged(rows):
    out = []
    for conv, turn, role, text in (r[:4] for r in rows):
        role, text = " " if role is None else role, " " if text is None else text
        name = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def best_edits(rows, costs):
    """(cost, letters, lines): for each place and state the least cost and letters, from the end."""
    ends = {"": (0, "", ()), "a": (0, "", ())}

    def with_inserts(best):
        for _ in range(4):
            for state, ways in NEXT.items():
                for initial, to in ways.items():
                    if initial != "s" and to in best:
                        c, letters, lines = best[to]
                        role = "user" if initial == "u" else "assistant"
                        best[state] = min(best.get(state, (1 << 60,)), (c + costs.insert, "I" + letters, (f"{role}:", *lines)))
        return best

    best = with_inserts(dict(ends))
    for _, _, role, text, fault in reversed(rows):
        now = {}
        for state in NEXT:
            ways = []
            if state in best:
                c, letters, lines = best[state]
                ways.append((c + costs.delete, "D" + letters, lines))
            if fault not in ("blank", "duplicate"):
                more = costs.truncated if fault == "truncated" else 0
                for initial, to in NEXT[state].items():
                    if to not in best:
                        continue
                    c, letters, lines = best[to]
                    if role[:1] == initial:
                        ways.append((c + more, "K" + letters, (f"{role}:{text}", *lines)))
                    if initial != "s":
                        other = "user" if initial == "u" else "assistant"
                        ways.append((c + more + costs.rerole, "R" + letters, (f"{other}:{text}", *lines)))
            if ways:
                now[state] = min(ways)
        best = with_inserts(now)
    return best[""]


def brute(rows, costs=None):
    """One tuple per conversation as ``repair_report`` returns it, of rows after damage."""
    costs = costs or Costs()
    parts = defaultdict(list)
    for r in rows:
        parts[r[0]].append(r)
    out = {}
    for conv, own in parts.items():
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0))
        seen, marked = set(), []
        for r in own:
            solid = re.sub(r"[\x20\x09-\x0D]", "", r[3])
            fault = "blank" if not solid else "duplicate" if r[2:4] in seen else "" if solid[-1] in ".!?" else "truncated"
            seen.add(r[2:4])
            marked.append((*r, fault))
        turns = {r[1] for r in own} - {None}
        initials = [r[2][:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        cost, audit, lines = best_edits(marked, costs)
        faults = [m[4] for m in marked]
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (conv, gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, sha)
    return out


def messy_turns(seed=5, conversations=60):
    random = np.random.default_rng(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "User", "aide", "umpire"]
    texts = ["Fine.", "Really?", "cut off", "", "  ", None, "é!\n", "more. ", "x ", "a\x0b"]
    rows = []
    for conv in range(conversations):
        n = int(random.integers(1, 14))
        for turn in range(n):
            plain = random.random() < 0.6
            role = ("user", "assistant")[turn % 2] if plain else roles[random.integers(len(roles))]
            text = f"t{random.integers(4)}." if random.random() < 0.5 else texts[random.integers(len(texts))]
            at = None if random.random() < 0.05 and not any(r[0] == conv and r[1] is None for r in rows) else turn * int(random.integers(1, 3)) + conv
            if not any(r[0] == conv and r[1] == at for r in rows):
                rows.append((conv if conv else None, at, role, text))
    rows += [(1000, None, "user", None), (1001, None, None, None), (1002, 3, "user", "only."), (1002, 3, "user", "only.")]
    return rows


def report(spark, rows):
    docs = spark.createDataFrame([(*r, 1, 2, 3, 4, 5, 6, "x") for r in rows], MESSY).repartition(3)
    return in_order(conversations.repair_report(docs).collect())


def test_report_on_messy_turns(spark):
    rows = messy_turns()
    found = brute(damaged(rows))
    empty = hashlib.sha256(b"").hexdigest()
    expected = [found.get(c, (c, 0, 0, 0, 0, 0, 0, "", empty)) for c in {r[0] for r in rows}]
    assert report(spark, rows) == in_order(expected)


def repaired(spark, rows, costs, chunk):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    conv, turns = conversations.repair(docs, costs, chunk)
    sums = {r["conv_id"]: r["sha"] for r in conversations.turn_digests(turns).collect()}
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    empty = hashlib.sha256(b"").hexdigest()
    return in_order((*[r[n] for n in names], sums.get(r["conv_id"], empty)) for r in conv.collect())


def spaced(rows):
    return [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]


@pytest.mark.parametrize("chunk", [1, 3])
def test_chunks_of_any_size(spark, chunk):
    """Long conversations cut everywhere; inserts cheap enough to be used."""
    random = np.random.default_rng(chunk)
    rows = [(7, t, ["user", "assistant", "system", "tool"][random.choice(4, p=[0.4, 0.4, 0.1, 0.1])], f"{random.integers(30)}{random.choice(['.', ''])}") for t in range(90)]
    # parity travels through all of it, so vectors never converge
    rows += [(8, t, "user", f"line {t}.") for t in range(61)]
    rows += [(9, t, "assistant", f"line {t}") for t in range(40)] + [(None, t, "user", "same.") for t in range(20)]
    costs = Costs(rerole=3, delete=4, insert=2, truncated=1)
    for used in (costs, Costs()):
        assert repaired(spark, rows, used, chunk) == in_order(brute(spaced(rows), used).values())


def test_vectors_that_differ_by_a_constant_count_as_equal():
    steps = conversations.Steps(Costs())
    blank = bytes([4 * conversations.BLANK])
    assert steps.front(steps.end, blank * 50) == (steps.end, 100)


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert conversations.repair_report(empty).collect() == []
