from __future__ import annotations

import math
import zlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from matchday.llm import hash_tree
from matchday.llm.hash_tree import Node, even_tree, grown, place, shard_of


def check(found, texts):
    by = {}
    for r in found:
        by.setdefault(r.shard, []).append(r.slot)
        assert 0 <= r.shard < 8 and r.grown_shard in (r.shard, 8)
    for slots in by.values():
        assert sorted(slots) == list(range(len(slots)))
    wanted = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts]
    assert sorted([(r.id, r.size, r.text_crc32) for r in found], key=repr) == sorted(wanted, key=repr)


def test_rows_are_placed(spark, odd, empty, documents, monkeypatch):
    monkeypatch.setattr(hash_tree, "ROWS_PER_BLOCK", 7)
    tree = even_tree(8)
    for docs in (odd, empty, spark.createDataFrame(documents)):
        found = place(docs, tree, grown(tree, 8)).collect()
        check(found, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_weights_and_confined_movement(spark):
    rows = spark.range(40_000)
    tree = Node("root", (Node("a", (Node("r", (Node("s0", shard=0), Node("s1", shard=1, weight=3))),)), Node("b", (Node("r", (Node("s2", shard=2, weight=4),)),))))
    lighter = Node("root", (Node("a", (Node("r", (Node("s0", shard=0), Node("s1", shard=1, weight=1))),)), tree.children[1]))
    more = grown(tree, 3, 2.0)
    key = F.col("id").cast("string")
    moved = rows.select(shard_of(key, tree).alias("t"), shard_of(key, more).alias("m"), shard_of(key, lighter).alias("l")).collect()
    shares = Counter(r.t for r in moved)
    assert abs(shares[0] / 40_000 - 1 / 8) < 0.01 and abs(shares[1] / 40_000 - 3 / 8) < 0.01
    assert {(r.t, r.m) for r in moved if r.t != r.m} == {(0, 3), (1, 3), (2, 3)}
    assert abs(sum(r.m == 3 for r in moved) / 40_000 - 2 / 10) < 0.01
    # less weight below region a: nothing enters shard 1, and shard 2 loses nothing
    assert {(r.t, r.l) for r in moved if r.t != r.l} <= {(0, 2), (1, 0), (1, 2)}


def drawn(key, tree):
    """The shard of a key by plain draws, level by level."""
    node, path = tree, tree.name
    while node.children:
        draws = []
        for child in node.children:
            if child.total > 0:
                mixed = xxhash.xxh64_intdigest(f"{path}/{child.name}".encode(), xxhash.xxh64_intdigest(key.encode(), 42))
                draws.append((-math.log(((mixed >> 11) + 0.5) / 2**53) / child.total, child.name, child))
        node = min(draws, key=lambda d: d[0])[2]
        path = f"{path}/{node.name}"
    return node.shard


def test_every_row_goes_where_plain_draws_send_it(spark, odd):
    uneven = Node("root", (
        Node("a", (Node("r", (Node("s0", shard=0, weight=0.5), Node("s1", shard=1, weight=3))), Node("q", (Node("s4", shard=4, weight=0.0), Node("s5", shard=5)))), ),
        Node("b", (Node("r", (Node("s2", shard=2, weight=4),)),)),
    ))
    for tree in (even_tree(8), grown(even_tree(8), 8), even_tree(5), uneven):
        found = spark.range(-50, 3000).select("id", shard_of(F.col("id").cast("string"), tree).alias("shard")).collect()
        assert {r.id: r.shard for r in found} == {i: drawn(str(i), tree) for i in range(-50, 3000)}
    placed = place(odd, even_tree(8), grown(even_tree(8), 8)).collect()
    for r in placed:
        name = "null" if r.id is None else str(r.id)
        assert (r.shard, r.grown_shard) == (drawn(name, even_tree(8)), drawn(name, grown(even_tree(8), 8)))


def test_no_weight_is_refused():
    with pytest.raises(ValueError):
        shard_of(F.lit("x"), Node("root", (Node("s", shard=0, weight=0.0),)))


def test_no_python(spark, documents):
    plan = place(spark.createDataFrame(documents), even_tree(8))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
