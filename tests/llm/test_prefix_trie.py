"""The conversation trie against a plain version over dictionaries."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from stationloom.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [x[1:] for x in sorted(v, key=lambda x: x[0])] for c, v in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in children[p]) or 1
        saved[p] = sum(saved[k] for k in children[p]) + ((len(members[p]) - 1) * len(p[-1][1]) if p else 0)
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(whole[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def nodes(spark, rows, schema=SCHEMA):
    df = prefix_trie.conversation_trie(spark.createDataFrame(rows, schema)).select(*prefix_trie.RESULT)
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("block", [1, 3, 16])
def test_random_conversations(spark, monkeypatch, block):
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    rng = random.Random(block)
    rows = [
        (rng.choice([0, 1, 2, 3, 100, 101, 102, 205, -3, -7, 250, None, *range(300, 340)]), i, rng.choice(["user", "a", None]),
         rng.choice(["x", "yy", None, "é€"]))
        for i in range(500)
    ]
    assert nodes(spark, rows) == plain(rows)


def test_shared_and_long_conversations_over_many_shards(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "TURNS_PER_SHARD", 40)
    monkeypatch.setattr(prefix_trie, "IDS_TOGETHER", 3)
    rows = [(c, t, "user", f"turn {t}") for c in range(120) for t in range(4)]
    rows += [(500 + c, t, "user", f"turn {t}" if t < 30 + c else f"other {c}") for c in range(5) for t in range(60)]
    rows += [(c, 0, "user", "alone") for c in range(1001, 1090)]
    assert nodes(spark, rows) == plain(rows)


def test_a_conversation_left_without_turns(spark):
    # no conversation leads 101's hundred, so its first turns are dropped
    short = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 2)
    rows = [(short, 0, "user", "a"), (short, 1, "user", "b"), (7, 0, None, None)]
    assert nodes(spark, rows) == plain(rows)
    assert nodes(spark, rows[:2]) == [(short, 0, None, 1, 0, 1, 0, hashlib.sha256(str(short).encode()).hexdigest())]


def test_order_repeats_and_nulls(spark):
    rows = [(0, 2, "u", "c"), (0, None, "u", "first"), (0, 1, "u", "b"), (0, 1, "u", "b"), (1, 5, None, "x"), (1, 3, "u", None)]
    assert nodes(spark, rows) == plain(rows)
    # equal turns have one order, whatever the order of the rows
    ties = [(0, 1, "u", x) for x in "abcdef"]
    assert nodes(spark, ties) == nodes(spark, ties[::-1])


def test_empty_table_and_extra_columns(spark):
    assert nodes(spark, []) == []
    odd = [(100, 0, "u", "x", 9, "k")]
    assert nodes(spark, odd, SCHEMA + ", n_convs int, ids string") == plain([odd[0][:4]])
