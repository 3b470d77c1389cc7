"""Runs of repeated words: minimizers at several scales seed long periods, scans at a lag find the short ones."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from matchday.llm.common import WHITE_SPACE, in_small_batches, named

#: The fewest words of a run, and the fewest periods.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Periods up to this one are found by scans at a lag, longer ones by minimizers.
LAGS = 36
#: Bytes of texts that a worker looks at together; a longer text is looked at by itself.
TOGETHER = 2 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_LAST = np.iinfo(np.uint64).max


def least_length(period: np.ndarray | int) -> np.ndarray | int:
    return np.maximum(LEAST_WORDS, LEAST_PERIODS * period)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """The least (or largest) value of every window of ``width``."""
    found, have = values, 1
    while have < width:
        step = min(have, width - have)
        found = pick(found[:-step], found[step:])
        have += step
    return found


class Sequence:
    """Words as numbers, with hashes of all prefixes: stretches compare by two subtractions."""

    def __init__(self, words: np.ndarray):
        self.words, self.n = words, len(words)
        self.powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(self.n, _BASE)]))
        weighted = _mixed(words.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)) * self.powers[: self.n]
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(weighted)])

    def grams(self, size: int, n: int) -> np.ndarray:
        """A hash of the ``size`` words from each of the first places, as far as they fit into ``n`` words."""
        count = n - size + 1
        return _mixed((self.sums[size : size + count] - self.sums[:count]) * self.powers[n - size :: -1][:count])

    def same(self, a: np.ndarray, lag: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the ``size`` words from ``a`` and from ``a + lag`` hash alike."""
        return (self.sums[a + size] - self.sums[a]) * self.powers[lag] == self.sums[a + lag + size] - self.sums[a + lag]

    def reach(self, a: np.ndarray, lag: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """How far the words before ``a`` and those from ``a`` on equal the ones a lag later; never too little."""
        back, ahead = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
        for step in (1 << i for i in reversed(range(max(1, n).bit_length()))):
            size = ahead + step
            fits = a + lag + size <= n
            ahead = np.where(fits & self.same(a, lag, np.where(fits, size, 0)), size, ahead)
            size = back + step
            fits = size <= a
            start = np.where(fits, a - size, a)
            back = np.where(fits & self.same(start, lag, a - start), size, back)
        return back, ahead

    def stretches(self, lag: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """All maximal stretches of this period that are long enough, by comparing every word."""
        unequal = np.flatnonzero(np.concatenate([[True], self.words[: n - lag] != self.words[lag:n], [True]]))
        starts, ends = unequal[:-1], unequal[1:] - 1 + lag
        long = ends - starts >= least_length(lag)
        return starts[long], ends[long]

    def grown(self, a: np.ndarray, lag: np.ndarray, n: int) -> list[tuple[int, int, int]]:
        """The maximal stretches (start, end, period) through the pairs of places ``a``, ``a + lag`` that are long enough."""
        back, ahead = self.reach(a, lag, n)
        found = np.stack([a - back, a + lag + ahead, lag], 1)[back + ahead + lag >= least_length(lag)]
        right, wrong = [], set()
        for start, end, period in np.unique(found, axis=0).tolist():
            if np.array_equal(self.words[start : end - period], self.words[start + period : end]):
                right.append((start, end, period))
            else:
                wrong.add(period)  # different words hashed alike
        for period in wrong:
            right += [(s, e, period) for s, e in zip(*(x.tolist() for x in self.stretches(period, n)), strict=True)]
        return right


def _by_lag(seq: Sequence, lag: int, n: int) -> list[tuple[int, int, int]]:
    """A run has enough equal pairs at this lag to cover a multiple of their number, and half of them on one side."""
    every = int(least_length(lag)) - lag
    at = np.arange(0, n - lag, every)
    at = at[seq.words[at] == seq.words[at + lag]]
    half = np.full(len(at), every // 2)
    lags = np.full(len(at), lag)
    ahead = np.where(at + lag + half <= n, half, 0)
    before = np.minimum(half, at)
    half_equal = ((ahead > 0) & seq.same(at, lags, ahead)) | ((before == half) & seq.same(at - before, lags, before))
    return seq.grown(at[half_equal], lags[half_equal], n)


def _by_minimizers(seq: Sequence, low: int, high: int, n: int, found: dict[tuple[int, int], int]) -> list[tuple[int, int, int]]:
    """Runs of periods above ``low`` up to ``high`` (at most 4/3 of it), when ``found`` has all of shorter ones.

    A gram is ``high // 2`` words, a window ``high`` grams. The first two periods of a run hold a window
    and the one a period later, with the same grams, so their minima are a period apart. Grams that are
    themselves periodic (a third of their length, so found before) do not count: a run of a longest
    period has another gram in every window, and equal ones among those are more than a sixth of a
    window apart, so a minimum pairs with a few others only.
    """
    size = high // 2
    hashes = seq.grams(size, n)
    periodic = np.zeros(len(hashes) + 1, np.int64)
    for (start, end), period in found.items():
        if period <= size // 3 and end - start >= size and start < len(hashes):
            periodic[start] += 1
            periodic[min(end - size + 1, len(hashes))] -= 1
    hashes[np.cumsum(periodic[:-1]) > 0] = _LAST
    if len(hashes) < high:
        return []
    least = _sliding(hashes, high, np.minimum)
    around = np.concatenate([np.zeros(high - 1, np.uint64), least, np.zeros(high - 1, np.uint64)])
    places = np.flatnonzero((_sliding(around, high, np.maximum) == hashes) & (hashes != _LAST))
    order = np.argsort(hashes[places], kind="stable")
    places = places[order]
    values = hashes[places]
    seeds, lags = [], []
    for step in range(1, len(places)):
        lag = places[step:] - places[:-step]
        near = (values[step:] == values[:-step]) & (lag <= high)
        if not near.any():
            break
        near &= lag > low
        seeds.append(places[:-step][near])
        lags.append(lag[near])
    return seq.grown(np.concatenate(seeds), np.concatenate(lags), n) if seeds else []


def runs_of(words: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, smallest period) of all runs of texts, which come longest first.

    ``words`` has a number for each word and after every text one that occurs nowhere else; ``ends``
    are the places of those.
    """
    seq = Sequence(words)
    lengths = np.diff(np.concatenate([[-1], ends])) - 1
    found: dict[tuple[int, int], int] = {}

    def up_to(period: int) -> int:
        """The words of all texts that have room for a run of this period."""
        texts = int(np.count_nonzero(lengths >= least_length(period)))
        return int(ends[texts - 1]) + 1 if texts else 0

    for lag in range(1, LAGS + 1):
        if n := up_to(lag):
            for start, end, period in _by_lag(seq, lag, n):
                found.setdefault((start, end), period)  # a multiple of a period has the same bounds
    low = LAGS
    while n := up_to(low + 1):
        high = low * 4 // 3
        for start, end, period in sorted(_by_minimizers(seq, low, high, n, found), key=lambda r: r[2]):
            found.setdefault((start, end), period)
        low = high
    return sorted((start, end, period) for (start, end), period in found.items())


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Parts of a batch of about TOGETHER bytes, with the words of their texts."""
    start, size, words = 0, 0, []
    for i, text in enumerate(batch.column("text").cast(pa.binary())):
        words.append((text.as_py() or b"").split())
        size += len(text.as_py() or b"")
        if size >= TOGETHER:
            yield batch.slice(start, i + 1 - start), words
            start, size, words = i + 1, 0, []
    if words:
        yield batch.slice(start), words


def _numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts as numbers, each text followed by a number of its own, and the places of those."""
    flat = pa.array([w for t in texts for w in t], pa.binary()).dictionary_encode()
    numbers = flat.indices.to_numpy().astype(np.int64)
    ends = np.cumsum([len(t) for t in texts])
    return np.insert(numbers, ends, len(flat.dictionary) + np.arange(len(texts))), ends + np.arange(len(texts))


RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def _tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in _slices(batch):
            longest_first = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
            words, ends = _numbered([texts[i] for i in longest_first])
            starts = np.concatenate([[0], ends[:-1] + 1])
            runs: list[list[dict]] = [[] for _ in texts]
            for start, end, period in runs_of(words, ends):
                text = int(np.searchsorted(ends, start))
                runs[longest_first[text]].append({"start": start - int(starts[text]), "length": end - start, "period": period})
            kept = []
            for own, found in zip(texts, runs, strict=True):
                if found:
                    drops = np.zeros(len(own) + 1, np.int64)
                    np.add.at(drops, [r["start"] + r["period"] for r in found], 1)
                    np.add.at(drops, [r["start"] + r["length"] for r in found], -1)
                    own = compress(own, (np.cumsum(drops[:-1]) == 0).tolist())
                kept.append(b" ".join(own))
            kind = pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "length", "period")]))
            columns = [part.column("id"), pa.array([len(t) for t in texts], pa.int64())]
            columns += [pa.array([sorted(r, key=lambda x: (x["start"], x["period"])) for r in runs], kind), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_words, runs (start, length, period in words), collapsed.

    Words are what stands between space and U+0009 to U+000D. A run is a stretch of words with a
    smallest period, of at least LEAST_WORDS words and LEAST_PERIODS periods, that no neighbouring word
    extends; runs come by start, then period. ``collapsed`` has the words that no run contains after its
    first period, joined by one space. A null or empty text has no words, no run and an empty
    ``collapsed``. Rows with equal or null ids are treated each by itself, other columns are ignored
    whatever their names, and an empty table gives an empty result.

    A text is one record and is looked at by one task, in time that grows with its words times the
    logarithm of their number; nothing moves between tasks.
    """
    rows = in_small_batches(docs).select(named(id_col).alias("id"), named(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_tag, f"id {dict(rows.dtypes)['id']}, n_words bigint, runs {RUNS}, collapsed string")


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) where the texts of about a tenth of the ids repeat a stretch of their words to the end.

    With h the crc32 of the decimal id and g = h / 10: where h is a multiple of 10, the p words from word
    a = g % n on repeat, p = 1 + (n - a) / (3 + g % 8). A null id and a text without words stay as they are.
    """
    h = F.crc32(named(id_col).cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all(named(text_col).cast("string"), F.lit(f"([^{WHITE_SPACE}]+)"), F.lit(1)))
    rows = docs.select(named(id_col).alias("id"), named(text_col).cast("string").alias("text"), F.floor(h / 10).alias("g"), words.alias("words"))
    rows = rows.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, (F.col("g") % F.col("n")).cast("int")))
    rows = rows.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))

    def cut(array: Column, start: Column | int, length: Column) -> Column:
        return F.slice(array, start, length)

    period = cut(F.col("words"), F.col("a") + 1, F.col("p"))
    turns = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    tail = cut(F.flatten(F.array_repeat(period, turns)), 1, F.col("n") - F.col("a"))
    planted = F.array_join(F.concat(cut(F.col("words"), 1, F.col("a")), tail), " ")
    return rows.select("id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))
