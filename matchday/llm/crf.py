"""Toxicity by a linear-chain conditional random field over words."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from matchday.llm.common import in_small_batches, named, sampled, with_fields
from matchday.workspace import materialise

#: Words of a chain; a text is a row of chains.
CHAIN = 32
#: The training sample: documents of each label, chains of each document.
DOCUMENTS_PER_LABEL, CHAINS_PER_DOCUMENT = 2500, 6
#: A word labels a token toxic if it stands at toxic places so many times as often as at others, and at so many that,
#: by chance alone, fewer words than this would stand at toxic places only.
LEAST_RATIO, CHANCE = 20.0, 5
#: Words whose scores a worker remembers; beyond, it starts anew.
REMEMBERED = 400_000
WORD = re.compile(r"\w+")


def features(word: str) -> list[str]:
    """What a word says about its own place."""
    w = word.lower()
    return [f"w={w}", *[f"p{n}={w[:n]}" for n in (3, 4, 5, 6) if len(w) >= n], f"s3={w[-3:]}"]


def marginals(scores: np.ndarray, there: np.ndarray, trans: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward and backward over chains (n, CHAIN) of scores of state 1 (state 0 scores 0).

    Returns the probability of state 1 at each place, that of each pair of states (n, CHAIN - 1, 2, 2),
    and the logarithm of the partition function. ``there`` marks the words; the rest is filling.
    """
    n, length = scores.shape
    move = np.exp(trans)
    emit = np.stack([np.ones_like(scores), np.exp(np.clip(scores, -30, 30))], 2) * there[:, :, None] + (1 - there[:, :, None])
    forward, log_z = np.empty((n, length, 2)), np.zeros(n)
    now = np.exp(start) * emit[:, 0]
    for t in range(length):
        if t:
            now = np.where(there[:, t, None], (forward[:, t - 1] @ move) * emit[:, t], forward[:, t - 1])
        total = now.sum(1)
        forward[:, t] = now / total[:, None]
        log_z += np.log(total)
    backward = np.ones((n, length, 2))
    pairs = np.zeros((n, length - 1, 2, 2))
    for t in range(length - 2, -1, -1):
        ahead = emit[:, t + 1] * backward[:, t + 1]
        joint = forward[:, t, :, None] * move[None] * ahead[:, None, :]
        pairs[:, t] = joint / joint.sum((1, 2))[:, None, None] * there[:, t + 1, None, None]
        back = ahead @ move.T
        backward[:, t] = np.where(there[:, t + 1, None], back / back.sum(1)[:, None], 1.0)
    both = forward * backward
    return both[:, :, 1] / both.sum(2) * there, pairs, log_z


def word_marginals(scores: np.ndarray, there: np.ndarray, trans: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Only the probability of state 1 at each place, in single precision."""
    n, length = scores.shape
    move = np.exp(trans).astype(np.float32)
    odds = np.exp(np.clip(scores, -30, 30)).T.astype(np.float32)  # (CHAIN, n)
    there = there.T
    f = np.empty((length, n), np.float32)  # the forward probability of state 1
    first = np.exp(start).astype(np.float32)
    one = first[1] * odds[0]
    f[0] = one / (one + first[0])
    for t in range(1, length):
        before = f[t - 1]
        zero = (1 - before) * move[0, 0] + before * move[1, 0]
        one = ((1 - before) * move[0, 1] + before * move[1, 1]) * odds[t]
        f[t] = np.where(there[t], one / (zero + one), before)
    r = np.ones(n, np.float32)  # backward score of state 1 over that of state 0
    out = np.empty((length, n), np.float32)
    for t in range(length - 1, -1, -1):
        if t < length - 1:
            ahead = odds[t + 1] * r
            r = np.where(there[t + 1], (move[1, 0] + move[1, 1] * ahead) / (move[0, 0] + move[0, 1] * ahead), 1)
        one = f[t] * r
        out[t] = one / (one + 1 - f[t]) * there[t]
    return out.T


@dataclass
class ToxicCRF:
    """Weights of features of a word, of the word before and the word after; moves between states; calibration."""

    own: dict[str, float] = field(default_factory=dict)
    left: dict[str, float] = field(default_factory=dict)
    right: dict[str, float] = field(default_factory=dict)
    bias: float = -6.0
    trans: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    start: np.ndarray = field(default_factory=lambda: np.zeros(2))
    calibration: tuple[float, float, float] = (-4.0, 3.0, 3.0)

    def of_word(self, word: str) -> tuple[float, float, float]:
        """Scores the word gives its own place, the next and the one before."""
        w = word.lower()
        get = self.own.get
        return (self.bias + sum([get(x, 0.0) for x in features(w)]), self.left.get(w, 0.0), self.right.get(w, 0.0))

    def score(self, total: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Of a document, from the sum and the maximum of its marginals."""
        a, b, c = self.calibration
        return 1 / (1 + np.exp(-np.clip(a + b * np.log1p(total) + c * most, -30, 30)))


class Tagger:
    """Applies the field to texts; remembers words."""

    def __init__(self, model: ToxicCRF):
        self.model = model
        self.reset()

    def reset(self) -> None:
        self.index: dict[str, int] = {"": 0}
        self.rows: list[tuple[float, float, float]] = [(0.0, 0.0, 0.0)]
        self.table = np.zeros((0, 3), np.float32)

    def _scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """(chains of scores, which places are words, chains of each text)."""
        if len(self.index) > REMEMBERED:
            self.reset()
        index, rows, of_word = self.index, self.rows, self.model.of_word
        places, chains = [], []
        for text in texts:
            words = WORD.findall(text)
            try:
                found = list(map(index.__getitem__, words))
            except KeyError:
                for w in words:
                    if w not in index:
                        index[w] = len(rows)
                        rows.append(of_word(w))
                found = list(map(index.__getitem__, words))
            count = -(-len(found) // CHAIN)
            places += found
            places += [0] * (count * CHAIN - len(found))
            chains.append(count)
        if len(rows) > len(self.table):
            self.table = np.concatenate([self.table, np.array(rows[len(self.table) :], np.float32).reshape(-1, 3)])
        where = np.array(places, np.int64)
        values = self.table[where]
        scores = values[:, 0].copy()
        # the words before and after count across chains of a text, not across texts
        edges = np.cumsum(chains)[:-1] * CHAIN
        after, before = values[1:, 2].copy(), values[:-1, 1].copy()
        inner = edges[(edges > 0) & (edges < len(where))]
        after[inner - 1] = before[inner - 1] = 0
        scores[:-1] += after
        scores[1:] += before
        return scores.reshape(-1, CHAIN), (where > 0).reshape(-1, CHAIN), chains

    def tag(self, texts: list[str]) -> list[np.ndarray]:
        """The marginal of every word of every text."""
        scores, there, chains = self._scores(texts)
        if not len(scores):
            return [np.zeros(0, np.float32) for _ in texts]
        found = word_marginals(scores, there, self.model.trans, self.model.start).reshape(-1)
        real = there.reshape(-1)
        out, at = [], 0
        for count in chains:
            end = at + count * CHAIN
            out.append(found[at:end][real[at:end]])
            at = end
        return out


def _tagged(model: ToxicCRF, threshold: float, span_at: float, place: int):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(model)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("marginal", pa.float64())]))
        for batch in batches:
            for at in range(0, max(1, batch.num_rows), 500):
                some = batch.slice(at, 500)
                texts = [t or "" for t in some.column(place).to_pylist()]
                found = tagger.tag(texts)
                total = np.array([float(f.sum(dtype=np.float64)) for f in found])
                most = np.array([float(f.max()) if len(f) else 0.0 for f in found])
                spans = []
                for text, f, m in zip(texts, found, most, strict=True):
                    spans.append([])
                    if m >= span_at:
                        marked = [(w.span(), float(p)) for w, p in zip(WORD.finditer(text), f, strict=True) if p >= span_at]
                        spans[-1] = [{"start": s, "end": e, "marginal": p} for (s, e), p in marked]
                scores = model.score(total, most)
                columns = [*some.columns, pa.array(scores, pa.float64()), pa.array((scores >= threshold).astype(np.int32)), pa.array(spans, kind)]
                columns += [pa.array(total, pa.float64()), pa.array(most, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, [*some.schema.names, *ADDED])

    return apply


#: The columns that :func:`tag` adds.
ADDED = ("score", "predicted", "spans", "total", "most")


def tag(docs: DataFrame, model: ToxicCRF, threshold: float = 0.3, span_at: float = 0.5, text_col: str = "text") -> DataFrame:
    """``docs`` plus score, predicted, spans, total and most; columns of these names are replaced.

    Every word of the whole text gets a marginal. ``total`` and ``most`` are their sum and maximum,
    ``score`` their calibrated combination, ``spans`` the offsets (in characters) of words with a
    marginal of at least ``span_at``. A null or empty text has no words and the score that belongs to
    that. The text is the only input; repeated rows get the same answer; an empty table gives an empty
    result.
    """
    rows = in_small_batches(docs).select(*[named(c) for c in docs.columns if c.lower() not in ADDED])
    place = rows.columns.index(text_col)
    out = "score double, predicted int, spans array<struct<start:int,end:int,marginal:double>>, total double, most double"
    return rows.mapInArrow(_tagged(model, threshold, span_at, place), with_fields(rows, out))


def _chains(lexicon: set[str]):
    """Chains of training documents: those with toxic words first, others drawn; (words, toxic) of each."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_words, all_marks = [], []
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                words = [w.lower() for w in WORD.findall(text or "")]
                marks = [int(bool(toxic) and w in lexicon) for w in words]
                if toxic and not any(marks):
                    continue  # nothing says which of its words are meant
                starts = list(range(0, len(words), CHAIN))
                with_marks = [s for s in starts if any(marks[s : s + CHAIN])]
                draw = np.random.default_rng(len(words))
                others = [s for s in draw.permutation(starts).tolist() if not any(marks[s : s + CHAIN])] if starts else []
                picked = [*draw.permutation(with_marks).tolist()[: CHAINS_PER_DOCUMENT - 2], *others[:2]]
                for s in map(int, picked):
                    all_words.append(words[max(0, s - 1) : s] + [""] * (s == 0) + words[s : s + CHAIN + 1])
                    all_marks.append(marks[s : s + CHAIN])
            yield pa.RecordBatch.from_pydict({"words": pa.array(all_words, pa.list_(pa.string())), "marks": pa.array(all_marks, pa.list_(pa.int32()))})

    return cut


def fit_chains(chains: list[tuple[list[str], list[int]]], steps: int = 80, rate: float = 0.25, ridge: float = 0.003) -> ToxicCRF:
    """Maximum likelihood with a ridge, by Adam over all chains. Each has the word before it in front and the next behind."""
    names: dict[str, int] = {}
    for words, marks in chains:
        for i, mark in enumerate(marks):
            if mark:
                around = [f"l={words[i]}", f"r={words[i + 2]}" if i + 2 < len(words) else "r="]
                for x in [*features(words[i + 1]), *around]:
                    names.setdefault(x, len(names))
    width, blank = 9, len(names)
    ids = np.full((len(chains), CHAIN, width), blank, np.int64)
    there = np.zeros((len(chains), CHAIN))
    truth = np.zeros((len(chains), CHAIN))
    for c, (words, marks) in enumerate(chains):
        for i, mark in enumerate(marks):
            around = [f"l={words[i]}", f"r={words[i + 2]}" if i + 2 < len(words) else "r="]
            known = [names[x] for x in [*features(words[i + 1]), *around] if x in names]
            ids[c, i, : len(known)] = known
            there[c, i], truth[c, i] = 1, mark
    # parameters: features, a blank that stays 0, bias, moves, start
    size = blank + 1 + 1 + 4 + 2
    theta, mean, square = np.zeros(size), np.zeros(size), np.zeros(size)
    theta[blank + 1] = -4
    seen = np.zeros((len(chains), CHAIN - 1, 2, 2))
    state = truth.astype(int)
    rows, places = np.nonzero(there[:, 1:])
    seen[rows, places, state[rows, places], state[rows, places + 1]] = 1
    seen_moves, first = seen.sum(0).sum(0), np.bincount(state[:, 0], minlength=2)
    mask = there.astype(bool)
    for step in range(1, steps + 1):
        scores = theta[ids].sum(2) + theta[blank + 1]
        p, pairs, _ = marginals(scores * there, mask, theta[blank + 2 : blank + 6].reshape(2, 2), theta[blank + 6 :])
        error = (p - truth) * there
        grad = np.bincount(ids.reshape(-1), np.repeat(error.reshape(-1), width), blank + 1)
        started = np.array([(1 - p[:, 0]).sum(), p[:, 0].sum()])
        grad = np.concatenate([grad, [error.sum()], (pairs.sum((0, 1)) - seen_moves).reshape(-1), started - first]) / len(chains)
        grad += ridge / 10 * theta
        grad[blank] = 0
        mean += 0.1 * (grad - mean)
        square += 0.02 * (grad * grad - square)
        theta -= rate * (1 - step / (steps + 1)) * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.98**step)) + 1e-9)
        theta[blank] = 0
    model = ToxicCRF(bias=float(theta[blank + 1]), trans=theta[blank + 2 : blank + 6].reshape(2, 2).copy(), start=theta[blank + 6 :].copy())
    for name, i in names.items():
        kind, value = name.split("=", 1)
        if kind == "l":
            model.left[value] = float(theta[i])
        elif kind == "r":
            model.right[value] = float(theta[i])
        else:
            model.own[name] = float(theta[i])
    return model


def calibrated(total: np.ndarray, most: np.ndarray, toxic: np.ndarray, ridge: float = 0.02) -> tuple[float, float, float]:
    """Logistic regression by Newton steps."""
    x = np.stack([np.ones_like(total), np.log1p(total), most], 1)
    theta = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * len(x) / 100 * np.eye(3)
        theta -= np.linalg.solve(hessian, x.T @ (p - toxic) + ridge * len(x) / 100 * theta)
    return tuple(map(float, theta))


def train(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> ToxicCRF:
    """Fits the field on documents with a label, where ``learn`` holds for the label's row.

    The sample is bounded: about DOCUMENTS_PER_LABEL documents of each label, drawn by hash. Labels are
    of documents; those of words come from the places that a word has in toxic and in other documents
    of the sample. A few chains of each document train the field, and the documents' own sums and maxima of
    marginals the calibration. Without a toxic or another document the model scores every text alike.
    A null id or label marks nothing; of labels that repeat for an id the highest is taken.
    """
    marked = labels.where(learn).where(named(id_col).isNotNull()).select(named(id_col).alias("id"), named(label_col).cast("int").alias("toxic"))
    drawn = sampled(marked.groupBy("id").agg(F.max("toxic").alias("toxic")), "toxic", DOCUMENTS_PER_LABEL, "id")
    texts = docs.select(named(id_col).alias("id"), named(text_col).cast("string").alias("text"))
    # both labels' sample is bounded, so is the side that is sent to every task
    sample = materialise(texts.join(F.broadcast(drawn), "id").dropDuplicates(["text", "toxic"]).select("text", "toxic"), "toxic-sample")
    counts = {bool(r.toxic): r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return ToxicCRF(calibration=(-4.0, 0.0, 0.0) if True not in counts else (0.0, 0.0, 0.0))
    # a word counts once for each word before it: what stands at many places, not in many copies of one
    found = F.regexp_extract_all(F.lower("text"), F.lit(r"(?U)(\w+)"))
    both = F.arrays_zip(F.concat(F.array(F.lit("")), "words").alias("before"), F.col("words").alias("word"))
    places = sample.select("toxic", found.alias("words")).select("toxic", F.explode(both).alias("x")).select("toxic", "x.before", "x.word").distinct()
    by_word = materialise(places.where("word is not null").groupBy("word").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")), "toxic-words")
    ratio = (F.col("t") / counts[True]) / ((F.col("c") + 0.5) / counts[False])
    share = counts[True] / (counts[True] + counts[False])
    least = math.log(max(1, by_word.count()) / CHANCE) / -math.log(share)
    lexicon = {r.word for r in by_word.where((F.col("t") >= least) & (ratio >= LEAST_RATIO)).select("word").collect()}
    chains = [(list(r.words), list(r.marks)) for r in sample.mapInArrow(_chains(lexicon), "words array<string>, marks array<int>").collect()]
    chains.sort()
    if not any(any(marks) for _, marks in chains):
        return ToxicCRF(calibration=(float(np.log(counts[True] / counts[False])), 0.0, 0.0))
    model = fit_chains(chains)
    seen = tag(sample, model).select("total", "most", "toxic").collect()
    columns = np.array(sorted((r.total, r.most, float(r.toxic)) for r in seen))
    model.calibration = calibrated(columns[:, 0], columns[:, 1], columns[:, 2])
    return model
