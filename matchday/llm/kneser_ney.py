"""Quality by the perplexity of an interpolated modified Kneser-Ney model over bytes, trained on trusted text."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from matchday.llm.common import in_small_batches, named, unit_draw
from matchday.workspace import materialise, new_folder

#: Bytes of an n-gram. Five fit a 64-bit key exactly; the tables below hold orders 1 to 5.
ORDER = 5
#: UTF-8 bytes of the texts that one task scores together, about.
BLOCK_BYTES = 24 << 20
#: Bytes whose n-grams are sorted at a time.
PIECE = 4 << 20
#: Most shards of the contexts, and blocks that ask a shard together. More blocks ask in groups, each with the shard's counts.
MOST_SHARDS, GROUP = 4096, 2048
#: Share of the trusted texts that set the thresholds instead of training the model.
SET_APART = 1 / 8


def grams_of(texts: list[bytes]) -> np.ndarray:
    """The n-gram that ends at every byte of every text; a text begins after ORDER - 1 zero bytes."""
    pad = b"\0" * (ORDER - 1)
    data = np.frombuffer(pad + pad.join(texts), np.uint8)
    ends = np.cumsum([len(t) + ORDER - 1 for t in texts])
    keys = np.zeros(max(0, len(data) - ORDER + 1), np.int64)
    for i in range(ORDER):
        keys = (keys << 8) | data[i : len(data) - ORDER + 1 + i]
    # those that end within the padding belong to no text
    starts = ends - np.array([len(t) for t in texts], np.int64) - (ORDER - 1)
    real = np.ones(len(keys), bool)
    for i in range(ORDER - 1):
        after = starts[1:] + i - (ORDER - 1)
        real[after[(after >= 0) & (after < len(keys))]] = False
    return keys[real]


def _pieces(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about PIECE bytes."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text) + ORDER
        if size >= PIECE:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.add.reduceat(counts, starts) if len(keys) else counts


def counted(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of the texts, ascending, and how often each occurs."""
    keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for a, b in _pieces(texts):
        k, c = np.unique(grams_of(texts[a:b]), return_counts=True)
        keys.append(k)
        counts.append(c.astype(np.int64))
    return _summed(np.concatenate(keys), np.concatenate(counts))


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """By the two bytes before the last. So a shard has all followers of its contexts, and all longer ones."""
    context = ((keys >> 8) & 0xFFFF).astype(np.uint64)
    return ((context * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % shards


def discounts(times: np.ndarray) -> np.ndarray:
    """D1, D2, D3+ from how many n-grams occur 1, 2, 3 and 4 times; index 0 is 0."""
    n = np.maximum(times.astype(float), 0.5)
    y = n[0] / (n[0] + 2 * n[1])
    found = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2]]
    return np.array([0.0, *np.clip(found, [0.05, 0.1, 0.15], [1.0, 2.0, 3.0])])


def suffixes(keys: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct suffixes of distinct n-grams and how many bytes stand before each: the continuation counts."""
    return np.unique(keys & ((1 << (8 * length)) - 1), return_counts=True)


class Level:
    """One order: counts, the contexts' totals and the weight that goes to the lower order."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, discount: np.ndarray):
        self.keys, self.counts, self.discount = keys, counts, discount
        contexts = keys >> 8
        starts = np.flatnonzero(np.append(True, contexts[1:] != contexts[:-1])) if len(keys) else np.zeros(0, np.int64)
        self.contexts = contexts[starts]
        off = discount[np.minimum(counts, 3)]
        self.totals = np.add.reduceat(counts, starts).astype(float) if len(keys) else np.zeros(0)
        self.rest = np.add.reduceat(off, starts) / self.totals if len(keys) else np.zeros(0)

    def over(self, keys: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """P of the last byte after the others, given P by the lower order."""
        if not len(self.keys):
            return lower
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        count = np.where(self.keys[at] == keys, self.counts[at], 0)
        where = np.minimum(np.searchsorted(self.contexts, keys >> 8), len(self.contexts) - 1)
        known = self.contexts[where] == keys >> 8
        own = np.maximum(count - self.discount[np.minimum(count, 3)], 0) / self.totals[where] + self.rest[where] * lower
        return np.where(known, own, lower)


def low_orders(pairs: np.ndarray) -> np.ndarray:
    """P of every byte after every byte (65,536), from the continuation counts of all pairs."""
    singles = (pairs.reshape(256, 256) > 0).sum(0).astype(np.int64)
    if not singles.sum():
        return np.full(65536, 1 / 256)
    d1 = discounts(np.array([(singles == k).sum() for k in (1, 2, 3, 4)]))
    off = d1[np.minimum(singles, 3)]
    one = np.maximum(singles - off, 0) / singles.sum() + off.sum() / singles.sum() / 256
    d2 = discounts(np.array([(pairs == k).sum() for k in (1, 2, 3, 4)]))
    keys = np.flatnonzero(pairs)
    level = Level(keys, pairs[keys], d2)
    every = np.arange(65536)
    return level.over(every, one[every & 255])


def probabilities(wanted: np.ndarray, keys: np.ndarray, counts: np.ndarray, times: dict[int, np.ndarray], two: np.ndarray) -> np.ndarray:
    """P of the last byte of each wanted n-gram, from the n-grams of its shard and the tables of all shards."""
    p = two[wanted & 0xFFFF]
    for length in range(3, ORDER + 1):
        mask = (1 << (8 * length)) - 1
        own = (keys, counts)
        for shorter in range(ORDER - 1, length - 1, -1):
            own = suffixes(own[0], shorter)
        p = Level(*own, discounts(times[length])).over(wanted & mask, p)
    return p


# --- blocks of documents, in the shared folder


def _write_blocks(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            name = f"{base}/{uuid.uuid4().hex}.parquet"
            table = pa.Table.from_batches(held)
            with store.open_output_stream(name) as out:
                pq.write_table(table.select(["text"]), out, compression="zstd", compression_level=6, use_dictionary=False, row_group_size=4096)
            rows = table.num_rows
            columns = [pa.array([name] * rows), pa.array(range(rows), pa.int64()), *[table[c].combine_chunks() for c in ("id", "lang", "apart")]]
            return pa.RecordBatch.from_arrays(columns, ["block", "place", "id", "lang", "apart"])

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                if held and size + some.column("text").nbytes > BLOCK_BYTES:
                    yield flush()
                    held, size = [], 0
                held.append(some)
                size += sum(len(x or "") for x in some.column("text").to_pylist())
        if held:
            yield flush()

    return write


def _texts(folder: str, block: str) -> list[bytes]:
    store, _ = fs.FileSystem.from_uri(folder)
    with store.open_input_file(block) as file:
        return [x or b"" for x in pq.read_table(file)["text"].cast(pa.binary()).to_pylist()]


def _packed(keys: np.ndarray) -> bytes:
    return np.diff(keys, prepend=0).astype("<i8").tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, "<i8"))


def _split(keys: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, the places of its keys), in order of the shards."""
    shard = shard_of(keys, shards)
    order = np.argsort(shard, kind="stable")
    edges = np.searchsorted(shard[order], np.arange(shards + 1))
    for s in range(shards):
        if edges[s] < edges[s + 1]:
            yield s, order[edges[s] : edges[s + 1]]


_PART = "shard long, block string, wanted binary, keys binary, counts binary"


def _count(folder: str, shards: int):
    def count(key: tuple, table: pa.Table) -> pa.Table:
        block = key[0].as_py()
        texts = _texts(folder, block)
        trusted = np.zeros(len(texts), bool)
        trusted[table["place"].to_numpy()] = table["learned"].to_numpy(zero_copy_only=False)
        keys, counts = counted([t for t, k in zip(texts, trusted, strict=True) if k])
        others, _ = counted([t for t, k in zip(texts, trusted, strict=True) if not k])
        rows = {s: [s, block, None, _packed(keys[at]), counts[at].astype("<i8").tobytes()] for s, at in _split(keys, shards)}
        every = np.union1d(keys, others)
        for s, at in _split(every, shards):
            rows.setdefault(s, [s, block, None, None, None])[2] = _packed(every[at])
        kinds = [pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.binary()]
        columns = list(zip(*rows.values(), strict=True)) if rows else [[]] * 5
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["shard", "block", "wanted", "keys", "counts"])

    return count


def _counts_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys = [_unpacked(x) for x in table["keys"].to_pylist()]
    counts = [np.frombuffer(x, "<i8") for x in table["counts"].to_pylist()]
    return _summed(np.concatenate(keys), np.concatenate(counts))


def _add(key: tuple, table: pa.Table) -> pa.Table:
    """The counts that a group of blocks brings to a shard."""
    keys, counts = _counts_of(table)
    return pa.table({"shard": [key[0].as_py()], "keys": [_packed(keys)], "counts": [counts.astype("<i8").tobytes()]})


def _merge(key: tuple, table: pa.Table) -> pa.Table:
    """The counts of a shard, how many of its n-grams of each order occur 1 to 4 times, its pairs' continuation counts."""
    keys, counts = _counts_of(table)
    times, own = [], (keys, counts)
    for length in range(ORDER, 2, -1):
        if length < ORDER:
            own = suffixes(own[0], length)
        times += [int((own[1] == k).sum()) for k in (1, 2, 3, 4)]
    pairs, before = suffixes(own[0], 2)
    columns = {"shard": [key[0].as_py()], "keys": [_packed(keys)], "counts": [counts.astype("<i8").tobytes()]}
    columns |= {"times": pa.array([times], pa.list_(pa.int64())), "pairs": pa.array([pairs.tolist()], pa.list_(pa.int64()))}
    return pa.table(columns | {"before": pa.array([before.tolist()], pa.list_(pa.int64()))})


def _answer(times: dict[int, np.ndarray], two: np.ndarray):
    def answer(key: tuple, asked: pa.Table, model: pa.Table) -> pa.Table:
        keys = _unpacked(model["keys"][0].as_py()) if model.num_rows else np.zeros(0, np.int64)
        counts = np.frombuffer(model["counts"][0].as_py(), "<i8") if model.num_rows else np.zeros(0, np.int64)
        wanted = [_unpacked(x) for x in asked["wanted"].to_pylist()]
        every = np.unique(np.concatenate(wanted)) if wanted else np.zeros(0, np.int64)
        bits = -np.log2(probabilities(every, keys, counts, times, two)).astype("<f4")
        found = [bits[np.searchsorted(every, w)].tobytes() for w in wanted]
        return pa.table({"block": asked["block"], "wanted": asked["wanted"], "bits": pa.array(found, pa.binary())})

    return answer


def _score(folder: str):
    def score(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        texts = _texts(folder, key[0].as_py())
        keys = np.concatenate([np.zeros(0, np.int64), *[_unpacked(x) for x in answers["wanted"].to_pylist()]])
        bits = np.concatenate([np.zeros(0, np.float32), *[np.frombuffer(x, "<f4") for x in answers["bits"].to_pylist()]])
        order = np.argsort(keys, kind="stable")
        keys, bits = keys[order], bits[order]
        total = np.zeros(len(texts))
        for a, b in _pieces(texts):
            grams = grams_of(texts[a:b])
            at = np.searchsorted(keys, grams)
            if len(grams) and (at.max() >= len(keys) or (keys[at] != grams).any()):
                raise ValueError("an n-gram of the block has no answer")
            lengths = np.array([len(t) for t in texts[a:b]])
            sums = np.concatenate([[0], np.cumsum(bits[at], dtype=np.float64)])
            ends = np.cumsum(lengths)
            total[a:b] = sums[ends] - sums[ends - lengths]
        place = rows["place"].to_numpy()
        size = np.array([len(t) for t in texts], np.int64)
        columns = [rows["id"], rows["lang"], rows["trusted"], rows["apart"], pa.array(size[place]), pa.array(total[place])]
        return pa.Table.from_arrays(columns, ["id", "lang", "trusted", "apart", "n_bytes", "bits"])

    return score


def perplexities(docs: DataFrame, trusted_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", set_apart: float = 0.0) -> DataFrame:
    """One row per input row: id, lang, trusted, apart, n_bytes, bits, perplexity.

    ``trusted_ids`` has the ids whose texts train the model, with no bound: all of them but the share
    ``set_apart``, drawn by a hash of the text so that copies stay together. Those are ``apart``, scored by a model that
    did not see them, and tell :func:`judged` how trusted texts score. ``bits`` is
    the text's negative log-probability to base 2, ``perplexity`` 2 ** (bits / n_bytes), null for a text
    without bytes. A null id is not trusted. Rows that repeat are scored each; columns other than the
    three are ignored, whatever their names. An empty table gives an empty result; without trusted text
    every byte has 8 bits.

    Documents are written once, in compressed blocks of about BLOCK_BYTES, to the shared folder. A
    block asks for the n-grams it has, and its trusted documents bring counts; both are cut into shards
    by context. A shard merges its counts, and joins them with what the blocks ask. All orders above
    two are complete within a shard; how many n-grams have which count, and the 65,536 pairs, are
    summed over all shards. More than GROUP blocks bring and ask in groups, so neither side of a join grows with
    their number. A block gets its answers and reads its texts again. Neither texts nor
    places of n-grams are shuffled, and a hot source, language or text is spread as the files are.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "quality-blocks")
    uri = folder if "://" in folder or folder.startswith("file:/") else f"file://{folder}"
    store, base = fs.FileSystem.from_uri(uri)
    store.create_dir(base, recursive=True)
    rows = in_small_batches(docs).select(named(id_col).alias("id"), named(lang_col).cast("string").alias("lang"), F.coalesce(named(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("apart", unit_draw(F.col("text"), F.lit("apart")) < set_apart)
    kind = dict(rows.dtypes)["id"]
    placed = materialise(rows.mapInArrow(_write_blocks(uri), f"block string, place long, id {kind}, lang string, apart boolean"), "quality-rows")
    good = trusted_ids.select(F.col(trusted_ids.columns[0]).alias("_good")).where("_good is not null").distinct()
    placed = placed.join(good, placed["id"] == good["_good"], "left").withColumn("trusted", F.col("_good").isNotNull()).drop("_good")
    placed = placed.withColumn("learned", F.col("trusted") & ~F.col("apart")).withColumn("apart", F.col("trusted") & F.col("apart"))
    placed = materialise(placed, "quality-trusted")
    blocks = max(1, placed.select("block").distinct().count())
    shards, groups = min(MOST_SHARDS, max(16, 2 * blocks)), -(-blocks // GROUP)
    group = F.pmod(F.xxhash64("block"), F.lit(groups))
    # a row is small but its block is not: the number of tasks follows the blocks, not the bytes of the rows
    placed = placed.repartition(2 * blocks, "block")
    parts = materialise(placed.select("block", "place", "learned").groupBy("block").applyInArrow(_count(uri, shards), _PART), "quality-parts")
    kinds = "shard long, keys binary, counts binary, times array<long>, pairs array<long>, before array<long>"
    counts = parts.where("keys is not null")
    if groups > 1:
        counts = counts.withColumn("group", group).select("shard", "group", "keys", "counts").groupBy("shard", "group").applyInArrow(_add, "shard long, keys binary, counts binary")
    model = materialise(counts.select("shard", "keys", "counts").groupBy("shard").applyInArrow(_merge, kinds), "quality-model")
    summed = model.select(F.posexplode("times").alias("place", "n")).groupBy("place").agg(F.sum("n").alias("n")).collect()
    by_place = dict.fromkeys(range(4 * (ORDER - 2)), 0) | {r.place: r.n for r in summed}
    times = {ORDER - i: np.array([by_place[4 * i + k] for k in range(4)]) for i in range(ORDER - 2)}
    pairs = np.zeros(65536, np.int64)
    both = model.select(F.explode(F.arrays_zip("pairs", "before")).alias("x")).groupBy("x.pairs").agg(F.sum("x.before").alias("n"))
    for r in both.collect():  # at most 65,536 rows
        pairs[r[0]] = r.n
    asked = parts.withColumn("group", group).select("shard", "group", "block", "wanted").groupBy("shard", "group")
    told = model.select("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("group"), "keys", "counts").groupBy("shard", "group")
    answer = asked.cogroup(told).applyInArrow(_answer(times, low_orders(pairs)), "block string, wanted binary, bits binary")
    scored = placed.groupBy("block").cogroup(answer.groupBy("block"))
    scored = scored.applyInArrow(_score(uri), f"id {kind}, lang string, trusted boolean, apart boolean, n_bytes long, bits double")
    return scored.withColumn("perplexity", F.when(F.col("n_bytes") > 0, F.pow(F.lit(2.0), F.col("bits") / F.col("n_bytes"))))


def judged(scored: DataFrame, quantile: float = 0.98, slack: float = 0.1, widening: float = 2.0, prior: int = 200, accuracy: int = 10_000) -> DataFrame:
    """``scored`` plus shrunk, threshold and kept.

    A short text says little about itself, so ``shrunk`` is its perplexity together with ``prior`` bytes
    of the median trusted text of its language. The threshold of a language is the ``quantile`` of the
    shrunk perplexities of its n trusted texts, times 1 + ``widening`` / n, since few texts say little about
    their tail; a null language is one of its own. A text of few bytes may exceed it by up to ``slack``, a long one hardly. Where ``scored`` has texts that are ``apart``, they are the trusted texts
    that count here, as the model did not learn from them. A text
    is kept up to the threshold, if it has no bytes to judge, or if its language has no such text.
    """
    each = F.col("bits") / F.col("n_bytes")
    trusted = F.col("trusted") & (F.col("n_bytes") > 0)
    if "apart" in scored.columns and not scored.where("apart").isEmpty():
        trusted = trusted & F.col("apart")
    medians = scored.where(trusted).groupBy("lang").agg(F.percentile_approx(each, 0.5, accuracy).alias("_usual"))
    shrunk = F.pow(F.lit(2.0), (F.col("bits") + F.col("_usual") * prior) / (F.col("n_bytes") + prior))
    with_usual = _by_language(scored, medians).withColumn("shrunk", F.when(F.col("n_bytes") > 0, shrunk)).drop("_usual")
    bound = F.percentile_approx("shrunk", quantile, accuracy) * (1 + widening / F.count("shrunk"))
    bounds = with_usual.where(trusted).groupBy("lang").agg(bound.alias("threshold"))
    allowed = F.col("threshold") * (1 + slack * prior / (F.col("n_bytes") + prior))
    return _by_language(with_usual, bounds).withColumn("kept", F.coalesce(F.col("shrunk") <= allowed, F.lit(True)))


def _by_language(rows: DataFrame, table: DataFrame) -> DataFrame:
    table = table.withColumnRenamed("lang", "_lang")
    return rows.join(table, F.col("lang").eqNullSafe(F.col("_lang")), "left").drop("_lang")
