from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchday.llm import kneser_ney
from matchday.llm.kneser_ney import ORDER, counted, discounts, grams_of, judged, perplexities


def padded(text):
    data = b"\0" * (ORDER - 1) + text
    return [data[i : i + ORDER] for i in range(len(text))]


def brute_model(texts):
    """P(byte | four bytes) by the definition, with dictionaries."""
    counts = {ORDER: Counter(g for t in texts for g in padded(t))}
    for length in range(ORDER - 1, 0, -1):
        longer = defaultdict(set)
        for g in counts[length + 1]:
            longer[g[1:]].add(g[:1])
        counts[length] = {g: len(s) for g, s in longer.items()}
    off = {k: discounts(np.array([sum(v == n for v in c.values()) for n in (1, 2, 3, 4)])) for k, c in counts.items()}
    follow = {k: defaultdict(dict) for k in counts}
    for k, c in counts.items():
        for g, n in c.items():
            follow[k][g[:-1]][g[-1:]] = n

    def p(gram):
        k = len(gram)
        lower = p(gram[1:]) if k > 1 else 1 / 256
        here = follow[k].get(gram[:-1])
        if not here:
            return lower
        total = sum(here.values())
        n = here.get(gram[-1:], 0)
        rest = sum(off[k][min(v, 3)] for v in here.values()) / total
        return max(n - off[k][min(n, 3)], 0) / total + rest * lower

    return p


@pytest.mark.parametrize("block", [1000, 24 << 20])
def test_bits_equal_the_definition(spark, documents, odd, empty, monkeypatch, block):
    monkeypatch.setattr(kneser_ney, "BLOCK_BYTES", block)
    monkeypatch.setattr(kneser_ney, "PIECE", 700)
    small = spark.createDataFrame([(int(r.doc_id), r.text[:400], r.lang, "s") for r in documents.head(30).itertuples()], odd.select("doc_id", "text", "lang", "source").schema)
    for docs, good in ((small, [(i,) for i in range(0, 30, 2)] + [(None,), (4,)]), (odd, [(3,), (6,), (8,)]), (odd, []), (empty, [(1,)])):
        rows = docs.collect()
        ids = {g[0] for g in good}
        trained = [(r.text or "").encode() for r in rows if r.doc_id is not None and r.doc_id in ids]
        p = brute_model(trained)
        wanted = []
        for r in rows:
            text = (r.text or "").encode()
            seen = Counter(padded(text))
            wanted.append((r.doc_id, len(text), -sum(n * np.log2(p(g)) for g, n in seen.items())))
        found = perplexities(docs, spark.createDataFrame(good, "doc_id long")).collect()
        assert len(found) == len(wanted)
        key = lambda x: (x[0] is None, x[0] or 0, x[1], x[2])
        for (i, n, bits), r in zip(sorted(wanted, key=key), sorted(((r.id, r.n_bytes, r.bits) for r in found), key=key), strict=True):
            assert (i, n) == r[:2] and r[2] == pytest.approx(bits, rel=2e-5, abs=1e-4)


def test_probabilities_sum_to_one(documents):
    texts = [t.encode() for t in documents.text.head(20)]
    p = brute_model(texts)
    for context in (texts[0][10:14], b"\0\0\0\0", b"zzzz"):
        assert sum(p(context + bytes([b])) for b in range(256)) == pytest.approx(1)


def test_grams():
    texts = [b"abcdefg", b"", b"a", b"xyz" * 5, b""]
    wanted = [int.from_bytes(g, "big") for t in texts for g in padded(t)]
    assert grams_of(texts).tolist() == wanted
    keys, counts = counted(texts)
    assert dict(zip(keys.tolist(), counts.tolist(), strict=True)) == Counter(wanted)


def test_thresholds_are_those_of_the_language(spark):
    rows = [(i, "en", True, 1000, 2000.0 + i) for i in range(100)] + [(200, "en", False, 1000, 9000.0), (201, "en", False, 3, 30.0), (202, "de", False, 1000, 9000.0)]
    rows += [(203, None, True, 1000, 4000.0), (204, None, False, 1000, 4100.0), (205, "en", False, 0, 0.0)]
    found = {r.id: r.kept for r in judged(spark.createDataFrame(rows, "id long, lang string, trusted boolean, n_bytes long, bits double")).collect()}
    assert len(found) == len(rows)
    assert [i for i, kept in found.items() if not kept] == [200]


def test_groups_of_blocks_change_nothing(spark, documents, monkeypatch):
    monkeypatch.setattr(kneser_ney, "BLOCK_BYTES", 3000)
    some = spark.createDataFrame([(int(r.doc_id), r.text[:600], r.lang) for r in documents.head(40).itertuples()], "doc_id long, text string, lang string")
    good = spark.createDataFrame([(int(i),) for i in documents.doc_id.head(40)[::3]], "doc_id long")
    one = {r.id: (r.trusted, r.n_bytes, r.bits) for r in perplexities(some, good).collect()}
    monkeypatch.setattr(kneser_ney, "GROUP", 2)
    for r in perplexities(some, good).collect():
        assert (r.trusted, r.n_bytes) == one[r.id][:2] and r.bits == pytest.approx(one[r.id][2])


def test_texts_set_apart_train_nothing_and_set_the_threshold(spark, documents):
    texts = [t[:500] for t in documents.text.head(40)]
    some = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts + texts[:5])], "doc_id long, text string, lang string")
    good = spark.range(45).toDF("doc_id")
    found = {r.id: r for r in perplexities(some, good, set_apart=0.3).collect()}
    apart = [i for i, r in found.items() if r.apart]
    # copies stay together, and the model is the one of the others alone
    assert 0 < len(apart) < 30 and all(found[i].apart == found[40 + i].apart for i in range(5))
    others = good.where(~F.col("doc_id").isin(apart))
    for r in perplexities(some, others).collect():
        assert r.bits == pytest.approx(found[r.id].bits)
    scored = [("a", True, True, 1000, 4000.0), ("b", True, True, 1000, 4050.0), ("c", True, False, 1000, 2000.0), ("d", False, False, 1000, 4200.0), ("e", False, False, 1000, 8000.0)]
    frame = spark.createDataFrame([(i, "en", *rest) for i, *rest in scored], "id string, lang string, trusted boolean, apart boolean, n_bytes long, bits double")
    assert sorted(r.id for r in judged(frame).collect() if not r.kept) == ["e"]
