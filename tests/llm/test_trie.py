from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from matchday.llm import trie
from matchday.llm.trie import conversation_trie, prefix_trie, rebuilt, turn_paths

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def conversations_of(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            found[conv].append((turn is not None, turn, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(turns, key=lambda x: x[:2])] for c, turns in found.items()}


def rebuilt_plainly(convs):
    made = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        made[c] = convs.get(c - c % 20, [])[:h] + own[h:]
    return made


def nodes_of(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        below = children[path]
        leaves[path] = sum(leaves[x] for x in below) if below else 1
        words = len(path[-1][1].encode().split()) if path else 0
        saved[path] = (len(members[path]) - 1) * words + sum(saved[x] for x in below)
    found = []
    for path, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(convs[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        found.append((min(own), len(path), parent, len(own), len(children[path]), leaves[path], saved[path], digest))
    return sorted(found, key=repr)


def as_rows(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def test_whole_table(spark):
    turns = spark.read.parquet(f"{SMALL}/conversations.parquet")
    convs = conversations_of(turns.select("conv_id", "turn", "role", "text").collect())
    assert as_rows(conversation_trie(turns)) == nodes_of(convs)
    assert as_rows(prefix_trie(rebuilt(turn_paths(turns)))) == nodes_of(rebuilt_plainly(convs))


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_hot_groups_and_deep_paths(spark, monkeypatch, shards):
    monkeypatch.setattr(trie, "SPLITTER_TURNS", 4)
    monkeypatch.setattr(trie, "IDS_PER_BLOCK", 7)
    draw, rows = random.Random(shards), []
    for c in range(-30, 300):
        # a third are copies of one conversation, another third shares a long beginning
        if c % 3 == 0:
            turns = [("user", f"hot {i}") for i in range(3)]
        elif c % 3 == 1:
            turns = [("user", f"deep {i} word") for i in range(9)] + [("user", str(draw.randrange(4)))] * draw.randrange(3)
        else:
            turns = [(draw.choice("ua"), f"t{draw.randrange(2)} x y") for _ in range(draw.randrange(1, 6))]
        rows += [(c, i, r, t) for i, (r, t) in enumerate(turns)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    convs = conversations_of(rows)
    assert as_rows(prefix_trie(turn_paths(frame), shards)) == nodes_of(convs)
    positive = frame.where("conv_id >= 0")
    wanted = nodes_of(rebuilt_plainly({c: t for c, t in convs.items() if c >= 0}))
    assert as_rows(prefix_trie(rebuilt(turn_paths(positive)), shards)) == wanted


def test_odd_and_empty_tables(spark):
    rows = [
        (None, 1, "user", "no id"), (1, None, None, None), (1, 2, "user", "hi there"), (2, None, "", ""), (2, 2, "user", "hi there"), (3, None, None, ""),
        (4, 5, "user", "long " * 5000), (5, 5, "user", "long " * 5000), (5, 5, "user", "long " * 5000), (40, 0, "user", "a"), (41, 0, "x", "b"),
    ]
    kind = "conv_id long, turn long, role string, text string, path string, node string, shard string, ends string, kind string, words string"
    frame = spark.createDataFrame([(*r, "p", "n", "s", "e", "k", "w") for r in rows], kind)
    assert as_rows(conversation_trie(frame)) == nodes_of(conversations_of(rows))
    assert as_rows(prefix_trie(rebuilt(turn_paths(frame)))) == nodes_of(rebuilt_plainly(conversations_of(rows)))
    # conversation 42 takes its first turns from one that has none, and may lose all of its own
    assert conversation_trie(frame.limit(0)).collect() == []
