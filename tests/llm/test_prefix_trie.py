"""The prefix trie against a plain one."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from goldweave.llm.common import scratch
from goldweave.llm.prefix_trie import Settings, prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows, span=100, heads=6):
    own = defaultdict(list)
    for conv, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        own[conv].append((role or "", text or ""))
    members = defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % heads
        base = c - (c % span if c >= 0 else -(-c % span))
        whole = own.get(base, [])[:h] + own[c][h:]
        for d in range(len(whole) + 1):
            members[tuple(whole[:d])].append((c, d == len(whole)))
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    low = {node: min(c for c, _ in m) for node, m in members.items()}
    below = {}
    for node in sorted(members, key=len, reverse=True):
        saved = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        below[node] = (max(1, sum(below[x][0] for x in children[node])), saved + sum(below[x][1] for x in children[node]))
    return sorted((
        (low[x], len(x), low[x[:-1]] if x else None, len(m), len(children[x]), *below[x],
         hashlib.sha256(",".join(str(c) for c in sorted(c for c, end in m if end)).encode()).hexdigest()) for x, m in members.items()), key=str)


def check(spark, rows, *settings):
    df = spark.createDataFrame([(*r, b"x", 5) for r in rows], "conv_id long, turn long, role string, text string, anchor binary, w int")
    expected = plain(rows)
    for cfg in settings:
        got = prefix_trie(df, scratch(spark, "test"), cfg)
        assert got.columns == COLUMNS
        assert sorted((tuple(r) for r in got.collect()), key=str) == expected, cfg
    return expected


def talks(seed, convs, turns, words=3):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "assistant"]), "é" * rng.randint(0, words)) for c in range(convs) for t in range(rng.randint(1, turns))]


SMALL = [Settings(), Settings(capacity=4, window=3), Settings(capacity=1, window=64), Settings(capacity=20, window=5)]


def test_random_conversations_in_containers_of_any_size(spark):
    check(spark, talks(1, 70, 9) + [(c + 90, *r[1:]) for c, r in ((c, r) for c in (3, 15, 120) for r in talks(2, 5, 7) if r[0] == 1)], *SMALL)


def test_long_conversations_that_part_late(spark):
    rng = random.Random(4)
    stem = [("user", f"turn {i}") for i in range(40)]
    rows = [(c, t, *x) for c in range(200, 212) for t, x in enumerate(stem[:rng.randint(20, 40)] + [("user", "own") for _ in range(c % 4)])]
    rows += [(c, t, *stem[t]) for c in range(300, 340) for t in range(c - 300)]  # each the start of the next
    rows += [(400, t, "user", str(t % 2)) for t in range(150)]
    check(spark, rows, Settings(), Settings(capacity=30, window=7), Settings(capacity=5, window=16))


def test_copies_ties_nulls_and_odd_ids(spark):
    rows = [(c, t, "user", "same") for c in range(1000, 1090) for t in range(5)]
    rows += [(None, 1, "user", "x"), (-5, 1, "user", "minus"), (-5, None, None, None), (-105, 1, "user", "minus"), (-100, 2, "a", "base"), (0, 1, "b", "zero")]
    rows += [(7, 1, "user", "x")] * 3 + [(7, 1, "assistant", "x"), (7, None, "user", ""), (7, 2, "", "userx"), (8, 2, "us", "erx")]
    rows += [(99999, 0, "user", "w " * 30000), (99998, 0, "user", "w " * 30000), (77777, 1, None, "only")]
    check(spark, rows, *SMALL[:3])


def test_empty_tables(spark):
    assert check(spark, [], Settings()) == []
    assert check(spark, [(None, 1, "user", "x")], Settings()) == []
