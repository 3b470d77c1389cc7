from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import functions as F

from matchday.llm import crf
from matchday.llm.common import held_out
from matchday.llm.crf import CHAIN, Tagger, ToxicCRF, marginals, tag, train, word_marginals


def test_marginals_equal_enumeration():
    draw = np.random.default_rng(1)
    trans, start = draw.normal(size=(2, 2)), draw.normal(size=2)
    for length in (1, 2, 5):
        scores = np.zeros((1, CHAIN))
        scores[0, :length] = draw.normal(size=length) * 2
        there = np.zeros((1, CHAIN), bool)
        there[0, :length] = True
        total, one = 0.0, np.zeros(length)
        for path in itertools.product((0, 1), repeat=length):
            s = start[path[0]] + sum(scores[0, t] * path[t] for t in range(length)) + sum(trans[a, b] for a, b in itertools.pairwise(path))
            total += np.exp(s)
            one += np.exp(s) * np.array(path)
        full, pairs, log_z = marginals(scores, there, trans, start)
        np.testing.assert_allclose(full[0, :length], one / total, rtol=1e-6)
        np.testing.assert_allclose(word_marginals(scores, there, trans, start)[0, :length], one / total, rtol=1e-4)
        np.testing.assert_allclose(log_z[0], np.log(total), rtol=1e-6)
        np.testing.assert_allclose(pairs[0, : length - 1].sum((1, 2)), 1)


def test_long_text_is_tagged_whole():
    model = ToxicCRF(own={"w=bad": 12.0}, left={"so": 2.0}, right={"thing": 2.0})
    text = "fine " * (CHAIN * 5 + 3) + "bad " + "fine " * 40 + "so bad thing"
    (found,) = Tagger(model).tag([text])
    assert len(found) == len(text.split())
    assert np.flatnonzero(found > 0.5).tolist() == [CHAIN * 5 + 3, CHAIN * 5 + 45]
    # a text's neighbours in the batch have no part in it
    for other in ("so", "", "x " * 33):
        np.testing.assert_allclose(Tagger(model).tag([other, text, "thing"])[1], found, rtol=1e-5)


def test_held_out_scores(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = train(docs, labels, ~held_out(F.col("doc_id")))
    found = tag(docs.select("doc_id", "text"), model).where(held_out(F.col("doc_id"))).join(labels, "doc_id").collect()
    toxic = [r for r in found if r.toxic]
    clean = [r for r in found if not r.toxic]
    assert len(toxic) > 50
    # about one label in twenty marks a text without any toxic word
    assert sum(r.predicted for r in toxic) / len(toxic) > 0.88
    assert sum(r.predicted for r in clean) / len(clean) < 0.02
    assert all(r.text[s.start : s.end].strip() for r in toxic for s in r.spans)


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(5, 1, 1), (6, 1, 0), (6, 1, 0), (None, 1, 1), (1, None, None), (8, 1, 0)], "doc_id long, quality int, toxic int")
    for labelled in (labels, labels.limit(0), labels.where("toxic = 1"), labels.where("toxic = 0")):
        model = train(odd, labelled, F.lit(True))
        found = tag(odd.withColumn("spans", F.lit("clash")), model).collect()
        assert len(found) == odd.count()
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
        scores = {}
        for r in found:
            scores.setdefault(r.text, set()).add(r.score)
        assert all(len(x) == 1 for x in scores.values())
    assert tag(empty, crf.ToxicCRF()).count() == 0
