from __future__ import annotations

import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from matchday.llm.periodic import least_length, periodic_runs, runs_of, with_planted_runs

SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"


def brute(words):
    """By the definition: every maximal stretch of every period, without those that have a smaller one."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        start = 0
        while start + q < n:
            end = start + q
            while end < n and words[end] == words[end - q]:
                end += 1
            if end - start >= max(24, 3 * q):
                found.setdefault((start, end), q)
            start = end - q + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone).decode()


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def found_in(texts):
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    parts, ends = [], []
    for mark, i in enumerate(order):
        parts += [*texts[i], 10**6 + mark]
        ends.append(len(parts) - 1)
    starts = [e - len(texts[i]) for e, i in zip(ends, order, strict=True)]
    result = [[] for _ in texts]
    for s, e, q in runs_of(np.array(parts, np.int64), np.array(ends)):
        k = int(np.searchsorted(ends, s))
        result[order[k]].append((s - starts[k], e - s, q))
    return [sorted(r) for r in result]


pieces = st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=70), st.integers(1, 9), st.integers(0, 40)), max_size=6)


@settings(max_examples=150, deadline=None)
@given(st.lists(pieces, min_size=1, max_size=3))
def test_runs_equal_the_definition(texts):
    texts = [[w for body, times, cut in t for w in (body * times)[: max(1, len(body) * times - cut)]] for t in texts]
    assert found_in(texts) == [brute(t) for t in texts]


@pytest.mark.parametrize("period", [1, 7, 8, 36, 37, 48, 49, 63, 64, 65, 97, 200, 333])
@pytest.mark.parametrize("extra", [-1, 0, 1])
def test_every_period_at_its_least_length(period, extra):
    draw = np.random.default_rng(period)
    body = draw.integers(0, 50_000, period).tolist()
    # nested periods: the body itself repeats a short piece in places
    body[: period // 2] = (body[:3] * period)[: period // 2]
    length = int(least_length(period)) + extra
    text = [*draw.integers(60_000, 90_000, 41).tolist(), *(body * (length // period + 1))[:length], *draw.integers(100_000, 190_000, 57).tolist()]
    assert found_in([text]) == [brute(text)]


def test_whole_table(spark, documents):
    rows = list(zip(documents.doc_id, documents.text, strict=True))
    short = [(i, t) for i, t in rows if len((t or "").split()) < 1500]
    frame = spark.createDataFrame(short, "doc_id long, text string")
    found = {r.id: r for r in periodic_runs(with_planted_runs(frame), "id").collect()}
    assert len(found) == len(short) and any(r.runs for r in found.values())
    for i, text in short:
        words = planted(i, (text or "").encode().split())
        assert [tuple(r) for r in found[i].runs] == brute(words), i
        assert found[i].n_words == len(words) and found[i].collapsed == collapsed(words, brute(words))


def test_odd_and_empty_tables(odd, empty):
    found = periodic_runs(odd).collect()
    wanted = []
    for r in odd.select("doc_id", "text").collect():
        words = (r.text or "").encode().split()
        wanted.append((r.doc_id, len(words), collapsed(words, brute(words)) if len(words) < 2000 else None))
    assert sorted(((r.id, r.n_words) for r in found), key=repr) == sorted((w[:2] for w in wanted), key=repr)
    by_id = {r.id: r for r in found}
    assert all(by_id[i].collapsed == text for i, _, text in wanted if i is not None and text is not None)
    # the long text repeats ten words 3000 times
    assert [tuple(r) for r in by_id[3].runs] == [(0, 30_000, 10)] and by_id[3].collapsed == "ein langes Wort und noch eins, it's a long text"
    assert periodic_runs(with_planted_runs(empty), "id").count() == 0
    assert with_planted_runs(odd).count() == odd.count()
