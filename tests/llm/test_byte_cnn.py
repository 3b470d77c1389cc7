from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from matchday.llm.byte_cnn import WIDTHS, WINDOW, ByteCNN, identify, train, windows_of
from matchday.llm.common import held_out, sampled


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = train(docs, ~held_out(F.col("doc_id")))
    found = identify(docs.drop("lang", "source"), model).where(held_out(F.col("doc_id"))).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) > 200
    assert sum(r.lang_pred == r.lang for r in found) / len(found) >= 0.95
    assert all(0 <= r.score <= 1 for r in found)


def test_odd_rows(spark, odd, empty):
    model = train(odd, F.lit(True))
    found = identify(odd.withColumn("score", F.lit("clash")).withColumn("lang_pred", F.lit("clash")), model).collect()
    assert len(found) == odd.count()
    for r in found:
        letters = any(map(str.isalpha, r.text or ""))
        assert (r.lang_pred == "und" and r.score == 0) if not letters else r.lang_pred in ("en", "de", "fr")
    assert train(empty, F.lit(True)) is None
    assert identify(empty, None).count() == 0
    assert {r.lang_pred for r in identify(odd, None).collect()} == {"und"}


def test_gradients_equal_differences():
    draw = np.random.default_rng(0)
    windows, answers = draw.integers(0, 256, (5, WINDOW)).astype(np.uint8), np.array([0, 1, 2, 0, 1])
    net = ByteCNN(["a", "b", "c"])

    def loss():
        return -np.log(net.predict(windows)[np.arange(5), answers]).mean()

    found = net._gradients(windows, answers)
    for name, g in found.items():
        flat = net.weights[name].reshape(-1)
        for at in np.argsort(-np.abs(g.reshape(-1)))[:4]:
            old = flat[at]
            flat[at] = old + 3e-3
            up = loss()
            flat[at] = old - 3e-3
            down = loss()
            flat[at] = old
            assert abs((up - down) / 6e-3 - g.reshape(-1)[at]) < 0.05 * max(0.02, abs(g.reshape(-1)[at]))


def test_windows_cover_the_text():
    text = bytes(range(256)) * 3 + b"end"
    assert windows_of(text).tobytes().rstrip(b"\0") == text
    assert windows_of(b"").shape == (1, WINDOW) and max(WIDTHS) < WINDOW


def test_more_labels_than_rows_to_learn_from(spark):
    rows = spark.range(6000).select(F.col("id").alias("doc_id"), (F.col("id") % 1200).cast("string").alias("lang"))
    drawn = sampled(rows, "lang", 1000, "doc_id", most=600)
    assert 400 < drawn.count() < 800 and drawn.columns == rows.columns
    assert sampled(rows, "lang", 3, "doc_id").groupBy("lang").count().count() > 900


def plainly(net, window):
    filters, bias, logits = net.weights["filters"], net.weights["bias"], net.weights["out_bias"].astype(float).tolist()
    rows = [net.weights["embedding"][b].astype(float).tolist() for b in window]
    for f in range(filters.shape[1]):
        width = WIDTHS[f // (filters.shape[1] // len(WIDTHS))]
        column = filters[:, f].astype(float).tolist()
        size = len(rows[0])
        best = max(
            sum(x * column[k * size + e] for k in range(width) for e, x in enumerate(rows[place + k])) for place in range(len(window) - max(WIDTHS) + 1)
        )
        logits = [old + max(0.0, best + float(bias[f])) * float(w) for old, w in zip(logits, net.weights["out"][f], strict=True)]
    odds = [math.exp(x - max(logits)) for x in logits]
    return [x / sum(odds) for x in odds]


def test_prediction_equals_plain_loops():
    """Embedding, filters of each width, their maximum over all places, and softmax, one number at a time."""
    draw = np.random.default_rng(3)
    windows = draw.integers(0, 256, (2, WINDOW)).astype(np.uint8)
    net = ByteCNN(["a", "b", "c"])
    assert net.predict(windows).shape == (2, 3)
    np.testing.assert_allclose(net.predict(windows), [plainly(net, w) for w in windows], rtol=1e-3, atol=1e-5)
