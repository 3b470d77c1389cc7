from __future__ import annotations

import random

import numpy as np
import pytest

from matchday.llm import suffix
from matchday.llm.suffix import FIRST, THRESHOLD, lengths_of, ranks_of, without_repeats


def brute(rows, threshold=THRESHOLD):
    """By the definition, text after text in order of id."""
    seen, found = set(), []
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - threshold + 1):
            string = data[at : at + threshold]
            if string in seen:
                gone[at : at + threshold] = b"\1" * threshold
            seen.add(string)
        spans, at = [], 0
        while at < len(data):
            end = at
            while end < len(data) and gone[end]:
                end += 1
            if end > at:
                spans.append((at, end - at))
            at = max(end, at + 1)
        found.append((i, len(data), spans, bytes(b for b, g in zip(data, gone, strict=True) if not g)))
    return sorted(found, key=repr)


def as_rows(df):
    return sorted(((r.id, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in df.collect()), key=repr)


def passages(seed, docs=120):
    draw = random.Random(seed)
    words = ["".join(draw.choices("abcdefgh", k=draw.randrange(2, 9))) for _ in range(60)]
    shared = [" ".join(draw.choices(words, k=draw.randrange(5, 60))) for _ in range(8)]
    shared += ["x" * 300, "ab" * 120, "é" * 90, "\n" + "-" * 99, shared[0][:120]]
    rows = []
    for i in range(docs):
        parts = []
        for _ in range(draw.randrange(1, 6)):
            parts.append(draw.choice(shared)[draw.randrange(6) :] if draw.random() < 0.5 else " ".join(draw.choices(words, k=draw.randrange(1, 50))))
        rows.append((i, " ".join(parts)))
    # a third of the table are copies, some with an edit
    return rows + [(docs + i, rows[0][1] * 3 if i % 4 else rows[0][1] + str(i)) for i in range(docs // 2)]


@pytest.mark.parametrize(("threshold", "first"), [(100, 36), (100, 25), (100, 60), (24, 8), (50, 50), (16, 4)])
def test_equals_brute_force(spark, monkeypatch, threshold, first):
    # many chunks and blocks, and shards of a few ranks
    monkeypatch.setattr(suffix, "RANKS_PER_SHARD", 64)
    rows = passages(threshold + first)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert as_rows(without_repeats(frame, threshold=threshold, first=first, chunk_bytes=3000)) == brute(rows, threshold)


def test_blocks_do_not_change_ranges():
    draw = np.random.default_rng(5)
    data = draw.integers(97, 100, 30_000).astype(np.uint8)
    data[10_000:12_000] = data[2_000:4_000]
    for length in (8, 16, 36, 72, 100):
        ranks = ranks_of(data, length)
        assert len(ranks) == len(data) - length + 1
        by_rank = {}
        for at, rank in enumerate(ranks.tolist()):
            assert by_rank.setdefault(rank, data[at : at + length].tobytes()) == data[at : at + length].tobytes()
        assert len(by_rank) == len({data[at : at + length].tobytes() for at in range(len(ranks))})


def test_lengths_double_to_the_threshold():
    assert lengths_of(100, 36) == [36, 72] and lengths_of(100, 25) == [25, 50] and lengths_of(100, 100) == [100]
    assert FIRST < THRESHOLD


def test_whole_table(spark, documents):
    rows = list(zip(documents.doc_id.tolist(), documents.text, strict=True))
    found = as_rows(without_repeats(spark.createDataFrame(documents).repartition(3), chunk_bytes=50_000))
    assert found == brute(rows) and any(r[2] for r in found)


def test_odd_and_empty_tables(odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert as_rows(without_repeats(odd)) == brute(rows)
    assert without_repeats(empty).collect() == []
    assert without_repeats(odd.where("text is null")).count() == 1
