from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from matchday.llm import lsh_forest
from matchday.llm.lsh_forest import DEPTH, TREES, climbed, depth_for, drop_near_duplicates, has_room, linked, near_duplicates, paths, recall_at, shingles, signature, tied


def words(text):
    w = (text or "").lower().split() if (text or "").isascii() else (text or "").lower().encode().split()
    w = [x if isinstance(x, bytes) else x.encode() for x in w]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """(id, class, links) by comparing all pairs."""
    sets = [words(t) for _, t in rows]
    links, near = Counter(), {i: {i} for i in range(len(rows))}
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= 0.8 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                near[i].add(j)
                near[j].add(i)
    found, seen = [], {}
    for i in range(len(rows)):
        if i not in seen:
            group, todo = {i}, [i]
            while todo:
                for k in near[todo.pop()] - group:
                    group.add(k)
                    todo.append(k)
            ids = [rows[k][0] for k in group if rows[k][0] is not None]
            for k in group:
                seen[k] = min(ids) if ids else None
        found.append((rows[i][0], seen[i], links[i]))
    return found


@pytest.fixture(scope="module")
def edited(spark, documents):
    """The small documents, and copies with a few words changed: chains, blocks of near copies, texts just below."""
    draw = np.random.default_rng(7)
    rows = [(int(d), t) for d, t in zip(documents.doc_id, documents.text, strict=True)]
    for k, base in enumerate([rows[i][1].split() for i in (3, 10, 40)]):
        for j in range(25):
            w = list(base)
            for at in draw.integers(0, len(w), max(1, len(w) * (j % 6) // 60)):
                w[at] = f"edit{draw.integers(99)}"
            rows.append((10_000 + 100 * k + j, " ".join(w)))
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("block", [2048, 8])
def test_links_equal_brute_force(spark, edited, odd, empty, monkeypatch, block):
    monkeypatch.setattr(lsh_forest, "BLOCK", block)
    for docs in (edited, odd, empty):
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        found = [(r.id, r.class_id, r.n_links) for r in near_duplicates(docs).collect()]
        assert sorted(found, key=repr) == sorted(brute(rows), key=repr)


def test_sets_are_compared_exactly():
    draw = np.random.default_rng(3)
    base = draw.integers(0, 10**6, 60).astype(np.uint64)
    sets = [np.unique(np.where(draw.random(60) < 0.12, draw.integers(0, 10**6, 60).astype(np.uint64), base)) for _ in range(40)]
    sets += [np.unique(draw.integers(0, 50, 30).astype(np.uint64)) for _ in range(20)]
    wanted = {
        (i, j) for i in range(60) for j in range(i + 1, 60)
        if len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j]))
    }
    assert wanted and {(i, int(j)) for i, js in linked(sets) for j in js} == wanted
    side = np.arange(60) % 2
    assert {(i, int(j)) for i, js in linked(sets, side) for j in js} == {(i, j) for i, j in wanted if side[i] != side[j]}


def test_prefix_is_shortened_to_the_recall():
    depth = depth_for(0.999)
    assert recall_at(depth) >= 0.999 > recall_at(depth + 1)
    assert depth_for(0.9) > depth


def test_one_row_of_each_class_stays(spark, edited, odd, empty):
    left = drop_near_duplicates(odd)
    assert left.columns == odd.columns and drop_near_duplicates(empty).count() == 0
    classes = {c for _, c, _ in brute([(r.doc_id, r.text) for r in edited.collect()])}
    assert sorted(r.doc_id for r in drop_near_duplicates(edited).collect()) == sorted(classes)
    # null and empty texts stay, of the others one for each class
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted([None, None, 1, 2, 3, 5, 7, 8], key=str)


def test_shingles_of_short_texts():
    assert len(shingles("a b")) == 1 and len(shingles("")) == len(shingles(None)) == 0
    assert len(shingles("a b c d e f")) == 2
    assert shingles("a b")[0] != shingles("b a")[0]


def trie_rows(draw, n):
    """Paths of one trie with few digits, so that many prefixes are shared, in order."""
    digits = draw.integers(0, 3, (n, 1 + DEPTH)).astype(">u2")
    digits[:, 0] = 0
    return digits[np.lexsort(digits.T[::-1])]


def test_paths_are_tied_by_their_longest_prefix():
    digits = trie_rows(np.random.default_rng(5), 400)
    head, depth = climbed(digits, 3)
    rows = [tuple(r) for r in digits.tolist()]
    for i, (h, d) in enumerate(zip(head, depth, strict=True)):
        longest = max([k for k in range(DEPTH + 1) if i and rows[i][: 1 + k] == rows[i - 1][: 1 + k]], default=0)
        if longest < 3:
            assert (h, d) == (i, 0)
        else:
            assert d == longest and h == next(j for j in range(i) if rows[j][: 1 + d] == rows[i][: 1 + d])
    # equal paths are answered by the whole path and go on to no shorter one
    assert len(digits) > len(set(rows)) and all(depth[i] == DEPTH for i in range(1, len(rows)) if rows[i] == rows[i - 1])


@pytest.mark.parametrize("partitions,batch", [(1, 10_000), (16, 7)])
def test_ties_unite_the_texts_below_a_node(spark, partitions, batch):
    """Nodes that go over the ends of batches and partitions, among them one that holds a third of all texts."""
    draw, shortest = np.random.default_rng(11), 5
    signatures = draw.integers(0, 2, (300, TREES * DEPTH)).astype(np.uint64)
    signatures[::3, : DEPTH - 2] = 0
    found = [paths(s) for s in signatures]
    rows = [(i.to_bytes(16, "big"), p.tobytes()) for i, p in enumerate(found)] + [(b"none", None)]
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.adaptive.coalescePartitions.enabled")}
    for key, value in zip(before, (partitions, batch, "false"), strict=True):
        spark.conf.set(key, value)
    try:
        ties = [(int.from_bytes(r.a, "big"), int.from_bytes(r.b, "big")) for r in tied(spark.createDataFrame(rows, "print binary, paths binary"), shortest).collect()]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)

    def united(pairs):
        top = list(range(300))
        for a, b in pairs:
            old, new = max(top[a], top[b]), min(top[a], top[b])
            top = [new if t == old else t for t in top]
        return top

    nodes = {}
    for i, p in enumerate(found):
        for row in p.tolist():
            nodes.setdefault(tuple(row[: 1 + shortest]), []).append(i)
    assert max(map(len, nodes.values())) >= 100
    together = [(a, below[0]) for below in nodes.values() for a in below]
    assert united(ties) == united(together)
    # no tie without a shared prefix
    assert all(any(tuple(x[: 1 + shortest]) == tuple(y[: 1 + shortest]) for x, y in zip(found[a].tolist(), found[b].tolist(), strict=True)) for a, b in ties)


def test_pairs_at_the_threshold_are_found():
    """Sets at a similarity of 0.8 share enough minima in some trie, 0.999 of them."""
    draw, depth, found = np.random.default_rng(2), depth_for(), 0
    for _ in range(2000):
        values = draw.integers(0, 2**63, 50, dtype=np.uint64)
        a, b = paths(signature(np.unique(values[:45]))), paths(signature(np.unique(values[5:])))
        assert len(a) == TREES
        found += bool((a[:, : 1 + depth] == b[:, : 1 + depth]).all(1).any())
    assert found >= 0.999 * 2000


def test_small_sets_have_no_similar_others():
    assert [has_room(n) for n in (1, 2, 3, 4, 50)] == [False, False, False, True, True]
