"""Language identification by a convolutional network over bytes, trained and applied in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from matchday.llm.common import in_small_batches, named, sampled, text_key, with_fields

#: Bytes of a window; widths of the filters, filters of each width, size of a byte's embedding.
WINDOW, WIDTHS, FILTERS, EMBEDDING = 256, (2, 3, 4), 16, 6
#: The training sample: documents of each language, windows of each document, and documents of all languages.
DOCUMENTS_PER_LANGUAGE, WINDOWS_PER_DOCUMENT, MOST_DOCUMENTS = 1500, 4, 60_000
#: Windows that go through the network at once.
BATCH = 512
UNKNOWN = "und"


class ByteCNN:
    """Embedding, filters of several widths, the maximum of each over the window, softmax."""

    def __init__(self, languages: list[str], seed: int = 0):
        draw = np.random.default_rng(seed)
        self.languages = languages
        widest, filters = max(WIDTHS), FILTERS * len(WIDTHS)
        # the filters of all widths stand side by side; the mask keeps the rows beyond a filter's width zero
        self.mask = np.zeros((widest * EMBEDDING, filters), np.float32)
        for i, width in enumerate(WIDTHS):
            self.mask[: width * EMBEDDING, i * FILTERS : (i + 1) * FILTERS] = 1
        self.weights = {
            "embedding": draw.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32),
            "filters": (draw.normal(0, 0.3, self.mask.shape) * self.mask).astype(np.float32),
            "bias": np.zeros(filters, np.float32),
            "out": draw.normal(0, 0.2, (filters, len(languages))).astype(np.float32),
            "out_bias": np.zeros(len(languages), np.float32),
        }

    def _patches(self, windows: np.ndarray) -> np.ndarray:
        """(window, place, embedding of the bytes from there on)."""
        embedded = self.weights["embedding"][windows].reshape(len(windows), -1)
        return np.lib.stride_tricks.sliding_window_view(embedded, max(WIDTHS) * EMBEDDING, axis=1)[:, ::EMBEDDING]

    def _pooled(self, patches: np.ndarray) -> np.ndarray:
        flat = np.ascontiguousarray(patches).reshape(-1, patches.shape[-1])
        return (flat @ self.weights["filters"]).reshape(*patches.shape[:2], -1)

    def _softmax(self, pooled: np.ndarray) -> np.ndarray:
        logits = pooled @ self.weights["out"] + self.weights["out_bias"]
        odds = np.exp(logits - logits.max(1, keepdims=True))
        return odds / odds.sum(1, keepdims=True)

    def predict(self, windows: np.ndarray) -> np.ndarray:
        """The probability of each language for windows (n, WINDOW) of bytes."""
        parts = [np.zeros((0, len(self.languages)), np.float32)]
        for at in range(0, len(windows), BATCH):
            responses = self._pooled(self._patches(windows[at : at + BATCH])).max(1)
            parts.append(self._softmax(np.maximum(responses + self.weights["bias"], 0)))
        return np.concatenate(parts)

    def mean(self, windows: np.ndarray) -> np.ndarray:
        """The mean of the probabilities over any number of windows."""
        return sum(self.predict(windows[at : at + BATCH]).sum(0, dtype=np.float64) for at in range(0, len(windows), BATCH)) / len(windows)

    def _gradients(self, windows: np.ndarray, answers: np.ndarray) -> dict[str, np.ndarray]:
        w, n = self.weights, len(windows)
        patches = self._patches(windows)
        responses = self._pooled(patches)
        places = responses.argmax(1)
        rows = np.arange(n)[:, None]
        before = np.take_along_axis(responses, places[:, None], 1)[:, 0] + w["bias"]
        pooled = np.maximum(before, 0)
        error = self._softmax(pooled)
        error[np.arange(n), answers] -= 1
        error /= n
        back = (error @ w["out"].T) * (before > 0)
        # only the place of the maximum has a gradient
        chosen = patches[rows, places]
        widest = max(WIDTHS)
        toward = (back[:, :, None] * w["filters"].T[None]).reshape(-1, EMBEDDING)
        bytes_there = windows[rows[:, :, None], places[:, :, None] + np.arange(widest)].reshape(-1)
        embedding = np.stack([np.bincount(bytes_there, toward[:, k], 256) for k in range(EMBEDDING)], 1)
        return {
            "embedding": embedding,
            "filters": np.einsum("nf,nfk->kf", back, chosen) * self.mask,
            "bias": back.sum(0),
            "out": pooled.T @ error,
            "out_bias": error.sum(0),
        }

    def fit(self, windows: np.ndarray, answers: np.ndarray, epochs: int = 6, batch: int = 128, rate: float = 0.004, seed: int = 0) -> ByteCNN:
        """Adam with a falling rate."""
        draw = np.random.default_rng(seed)
        mean = {k: np.zeros_like(v) for k, v in self.weights.items()}
        square = {k: np.zeros_like(v) for k, v in self.weights.items()}
        steps, step = epochs * -(-len(windows) // batch), 0
        for _ in range(epochs):
            order = draw.permutation(len(windows))
            for at in range(0, len(order), batch):
                some = order[at : at + batch]
                step += 1
                for k, g in self._gradients(windows[some], answers[some]).items():
                    mean[k] += 0.1 * (g - mean[k])
                    square[k] += 0.001 * (g * g - square[k])
                    falling = rate * (1 - step / (steps + 1))
                    self.weights[k] -= (falling * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self


def windows_of(text: bytes) -> np.ndarray:
    """The whole text as windows of WINDOW bytes; the last is filled up with zeros."""
    count = max(1, -(-len(text) // WINDOW))
    return np.frombuffer(text.ljust(count * WINDOW, b"\0"), np.uint8).reshape(count, WINDOW)


def _training_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        labels, found = [], []
        for text, lang, key in zip(*[batch.column(c).to_pylist() for c in ("text", "lang", "key")], strict=True):
            if not any(map(str.isalpha, text or "")):
                continue
            windows = windows_of(text.encode())
            places = np.random.default_rng(key % 2**32).permutation(len(windows))[:WINDOWS_PER_DOCUMENT]
            found += [windows[p].tobytes() for p in places]
            labels += [lang] * len(places)
        yield pa.RecordBatch.from_pydict({"lang": pa.array(labels, pa.string()), "window": pa.array(found, pa.binary())})


def train(docs: DataFrame, learn: Column, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> ByteCNN | None:
    """Fits the network on rows where ``learn`` holds and the language is not null; None if there is none.

    The sample is bounded: about DOCUMENTS_PER_LANGUAGE documents of each language, drawn by hash (evenly fewer
    where there are so many languages that it would be more than MOST_DOCUMENTS), and
    WINDOWS_PER_DOCUMENT windows from any place in each. Equal windows of a language count once, so
    copies weigh nothing. The driver holds 256 bytes for each window.
    """
    text = named(text_col).cast("string")
    rows = in_small_batches(docs).where(learn).select(
        named(id_col).cast("string").alias("id"), named(lang_col).cast("string").alias("lang"), text.alias("text"), text_key(text).alias("key")
    )
    chosen = sampled(rows, "lang", DOCUMENTS_PER_LANGUAGE, "key", "id", most=MOST_DOCUMENTS).select("lang", "text", "key")
    found = chosen.mapInArrow(_training_windows, "lang string, window binary").distinct().collect()
    if not found:
        return None
    found = sorted((r.lang, bytes(r.window)) for r in found)
    languages = sorted({lang for lang, _ in found})
    windows = np.frombuffer(b"".join(w for _, w in found), np.uint8).reshape(-1, WINDOW)
    return ByteCNN(languages).fit(windows, np.array([languages.index(lang) for lang, _ in found]))


def identify(docs: DataFrame, model: ByteCNN | None, text_col: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` plus the language and its score, as ``names``; columns of these names are replaced.

    The windows of the whole text go through the network; a language's score is the mean of its
    probabilities, and the highest is predicted (the first by name on a tie). A text that is null or
    has no letter is ``und`` with score 0, as is every text without a model. The text is the only
    input. Repeated rows get the same answer, an empty table gives an empty result.
    """
    rows = in_small_batches(docs).select(*[named(c) for c in docs.columns if c.lower() not in names])
    place = rows.columns.index(text_col)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, max(1, batch.num_rows), 256):
                some = batch.slice(at, 256)
                found, scores = [], []
                for text in some.column(place).to_pylist():
                    if model is None or not any(map(str.isalpha, text or "")):
                        found.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    mean = model.mean(windows_of(text.encode()))
                    found.append(model.languages[int(mean.argmax())])
                    scores.append(min(1.0, float(mean.max())))
                columns = [*some.columns, pa.array(found, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, [*some.schema.names, *names])

    return rows.mapInArrow(apply, with_fields(rows, f"`{names[0]}` string, `{names[1]}` double"))
