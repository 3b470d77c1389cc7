from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from matchday.llm.cqf import CountingQuotientFilter, drop_copies, exact_classes


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**48 - 1) | st.integers(0, 40), max_size=60), min_size=1, max_size=4))
def test_filters_merge_losslessly(parts):
    filters = [CountingQuotientFilter.from_bytes(CountingQuotientFilter.of(np.array(p, np.uint64)).to_bytes()) for p in parts]
    marks, counts = CountingQuotientFilter.merged(filters).items()
    assert dict(zip(marks.tolist(), counts.tolist(), strict=True)) == Counter(x for p in parts for x in p)
    assert marks.tolist() == sorted(marks.tolist())


def brute(rows):
    bare = [(i, t or "", (t or "").translate({c: None for c in [32, *range(9, 14)]})) for i, t in rows]
    groups = {}
    for i, t, b in bare:
        groups.setdefault(b, []).append((-len(t), i is None, i or 0))
    found = []
    for i, t, b in bare:
        best = min(groups[b])
        keep = None if best[1] else best[2]
        found.append((i, keep, len(groups[b]), len(t) == -best[0] and i == keep, hashlib.sha256(b.encode()).hexdigest()))
    return found


def order(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("name", ["documents", "odd", "empty"])
def test_classes_equal_brute_force(spark, odd, empty, documents, name):
    docs = {"odd": odd, "empty": empty, "documents": spark.createDataFrame(documents)}[name]
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = [(r.id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_classes(docs).collect()]
    assert order(found) == order(brute(rows))


def test_one_row_of_each_group_stays(odd, empty):
    left = drop_copies(odd)
    assert left.columns == odd.columns
    texts = [(r.text or "").translate({c: None for c in [32, *range(9, 14)]}) for r in left.collect()]
    assert len(texts) == len(set(texts)) == 5
    assert drop_copies(empty).count() == 0
