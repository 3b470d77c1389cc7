"""Removes byte strings that occur earlier: prefix doubling over positions, from sampled ranks to sorted pairs of ranks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from matchday.llm.common import in_small_batches, named, text_key
from matchday.workspace import materialise, new_folder

#: Bytes of a string, and of the first strings whose ranks are compared between texts. The length doubles from there.
THRESHOLD, FIRST = 100, 36
#: Bytes of texts that a worker holds at a time, and positions that it ranks at a time (less than 2 ** 20).
CHUNK, BLOCK = 8 << 20, 1 << 19
#: Sampled ranks that one task compares, on average.
RANKS_PER_SHARD = 1 << 18
#: Most tasks over which the chunks of texts are spread.
MOST_TASKS = 20_000

_PLACE = np.uint64((1 << 20) - 1)


def lengths_of(threshold: int, first: int) -> list[int]:
    """The lengths whose ranks are sampled: doubling from ``first`` up to the threshold."""
    found = [min(first, threshold)]
    while found[-1] * 2 < threshold:
        found.append(found[-1] * 2)
    return found


def _scrambled(x: np.ndarray) -> np.ndarray:
    """Another number for each number, in place."""
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    return x


def paired(ranks: np.ndarray, offset: int) -> np.ndarray:
    """The rank of two overlapping or adjacent strings from the ranks of both: the doubling step."""
    both = ranks[: len(ranks) - offset] * np.uint64(0x9E3779B97F4A7C15)
    both += ranks[offset:]
    return _scrambled(both)


def ranks_of(data: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit rank of the ``length`` bytes from every position, doubled up from eight bytes, which are their own rank."""
    have = min(8, length)
    padded = np.concatenate([data, np.zeros(8 - have, np.uint8)])
    words = np.lib.stride_tricks.as_strided(padded, (max(0, len(padded) - 7), 8), (1, 1)).copy().view("<u8").ravel()
    if have < 8:
        words &= np.uint64((1 << (8 * have)) - 1)
    ranks = _scrambled(words)
    while have < length:
        step = min(have, length - have)
        ranks, have = paired(ranks, step), have + step
    return ranks


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least value of every window."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values, have = np.minimum(values[:-step], values[step:]), have + step
    return values


class Chunk:
    """Texts one after another, in order of id, with the positions at which a string of ``threshold`` bytes starts."""

    def __init__(self, texts: pa.Array, threshold: int):
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        buffer = texts.buffers()[2]
        bytes_ = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
        self.data, self.ends = bytes_[offsets[0] : offsets[-1]], offsets[1:] - offsets[0]
        self.starts, self.threshold = offsets[:-1] - offsets[0], threshold
        room = self.ends - self.starts >= threshold
        self.alive = self.covered(self.starts[room], self.ends[room] - threshold + 1)

    def covered(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Which bytes lie in one of the intervals."""
        edges = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(edges, starts, 1)
        np.add.at(edges, ends, -1)
        return np.cumsum(edges[:-1], dtype=np.int32) > 0

    def blocks(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(positions, their bytes, whether they live) of a block at a time: what the strings of living positions reach, and no more."""
        for at in range(0, len(self.data), BLOCK):
            alive = np.concatenate([[0], self.alive[at : at + BLOCK].view(np.int8), [0]])
            firsts, ends = np.flatnonzero(np.diff(alive) > 0), np.flatnonzero(np.diff(alive) < 0)
            if len(firsts):
                reached = np.zeros(len(alive) + self.threshold, np.int32)
                np.add.at(reached, firsts, 1)
                np.add.at(reached, ends + self.threshold - 1, -1)
                places = np.flatnonzero(np.cumsum(reached, dtype=np.int32))
                yield places + at, self.data[at + places], self.alive[at + places] & (places < BLOCK)

    def samples(self, length: int) -> tuple[np.ndarray, ...]:
        """(first, last, rank, rank of all) of ranges of living positions whose strings have the same sample.

        The sample of a string is its substring of ``length`` bytes with the least rank, the leftmost of
        equal ones. It follows from the string alone, so equal strings have equal samples. The last rank
        is that of all bytes that the strings of the range reach: the first and the last overlap, so both
        and their distance tell all.
        """
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64))]
        for places, data, alive in self.blocks():
            ranks = ranks_of(data, length)
            order = (ranks & ~_PLACE) | np.arange(len(ranks), dtype=np.uint64)
            least = (_least(order, self.threshold - length + 1) & _PLACE).astype(np.int64)
            alive = alive[: len(least)]
            least[~alive] = -1
            firsts = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
            lasts = np.append(firsts[1:], len(least)) - 1
            firsts, lasts = firsts[alive[firsts]], lasts[alive[firsts]]
            full = paired(ranks, self.threshold - length)
            ends = np.stack([full[firsts] + (lasts - firsts).astype(np.uint64), full[lasts]], 1).ravel()
            found.append((places[firsts], places[lasts], ranks[least[firsts]], paired(ends, 1)[::2]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def keep(self, firsts: np.ndarray, lasts: np.ndarray, ranks: np.ndarray, whole: np.ndarray, repeated: dict[int, bytes], bits: int) -> tuple[np.ndarray, ...]:
        """The ranges whose rank occurs again, here or in another chunk; the positions of the others leave."""
        distinct, inverse, counts = np.unique(ranks, return_inverse=True, return_counts=True)
        again = counts > 1
        for shard, (low, high) in shards_of(distinct, bits):
            if shard in repeated:
                again[low:high] |= np.unpackbits(np.frombuffer(repeated[shard], np.uint8), count=high - low).astype(bool)
        stays = again[inverse]
        self.alive = self.covered(firsts[stays], lasts[stays] + 1)
        return firsts[stays], lasts[stays], ranks[stays], whole[stays]

    def living(self) -> bytes:
        """The ranges of living positions, to be read by :meth:`revive`."""
        edges = np.flatnonzero(np.diff(np.concatenate([[0], self.alive.view(np.int8), [0]])))
        return edges.astype("<i8").tobytes()

    def revive(self, living: bytes) -> None:
        edges = np.frombuffer(living, "<i8")
        self.alive = self.covered(edges[::2], edges[1::2])


def shards_of(distinct: np.ndarray, bits: int) -> Iterator[tuple[int, tuple[int, int]]]:
    """(shard, its range) of ascending ranks; the highest bits name the shard."""
    shards = (distinct >> np.uint64(64 - bits)).astype(np.int64)
    edges = np.flatnonzero(np.concatenate([[True], shards[1:] != shards[:-1]])[: len(shards)]).tolist()
    for low, high in zip(edges, [*edges[1:], len(shards)], strict=False):
        yield int(shards[low]), (low, high)


def _messages(chunk: int, path: str | None, living: bytes | None, distinct: np.ndarray, bits: int) -> pa.RecordBatch:
    """The distinct ranks of a chunk, each shard's as the 32 bits after those of the shard.

    Of no shard (-1): where the chunk is, in the first round, and which positions live, in later ones.
    """
    rows = [(shard, chunk, None, (distinct[a:b] << np.uint64(bits) >> np.uint64(32)).astype("<u4").tobytes()) for shard, (a, b) in shards_of(distinct, bits)]
    rows.append((-1, chunk, path, living))
    kinds = [("shard", pa.int64()), ("chunk", pa.int64()), ("path", pa.string()), ("ranks", pa.binary())]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(kinds)], [n for n, _ in kinds])


MESSAGE = "shard long, chunk long, path string, ranks binary"


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:/") else f"file://{uri}")


def _cut(folder: str, threshold: int, length: int, bits: int, most: int):
    """Writes the texts of a partition in chunks, each in order of id, and sends the first sampled ranks."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(folder)
        store.create_dir(base, recursive=True)
        number = TaskContext.get().partitionId() << 32
        parts, size = [], 0

        def flushed() -> Iterator[pa.RecordBatch]:
            nonlocal number, parts, size
            table = pa.concat_tables([pa.Table.from_batches([p]) for p in parts])
            table = table.take(pc.sort_indices(table, sort_keys=[("id", "ascending"), ("tie", "ascending")], null_placement="at_end")).combine_chunks()
            path = f"{base}/{number}-{uuid.uuid4().hex}.parquet"
            with store.open_output_stream(path) as out:
                pq.write_table(table, out, compression="zstd")
            _, _, ranks, _ = Chunk(table.column("text").combine_chunks().cast(pa.binary()), threshold).samples(length)
            yield _messages(number, path, None, np.unique(ranks), bits)
            number, parts, size = number + 1, [], 0

        for batch in batches:
            texts = pc.fill_null(batch.column("text").cast(pa.binary()), b"")
            batch = batch.set_column(batch.schema.get_field_index("text"), "text", texts)
            lengths = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
            at = 0
            while at < batch.num_rows:
                before = lengths[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(lengths, before + most - size, side="right")))
                parts.append(batch.slice(at, to - at))
                size += int(lengths[to - 1] - before)
                at = to
                if size >= most or at < batch.num_rows:
                    yield from flushed()
        if parts:
            yield from flushed()

    return cut


def _repeated(table: pa.Table) -> pa.Table:
    """For each chunk of a shard, which of its ranks another chunk has too."""
    ranks = [np.frombuffer(x, "<u4") for x in table.column("ranks").to_pylist()]
    distinct, counts = np.unique(np.concatenate([np.unique(r) for r in ranks]), return_counts=True)
    again = counts > 1
    bits = [np.packbits(again[np.searchsorted(distinct, r)]).tobytes() for r in ranks]
    return pa.table({"chunk": table.column("chunk"), "shard": table.column("shard"), "bits": pa.array(bits, pa.binary())})


ANSWER = "chunk long, shard long, bits binary"


def _chunk_of(folder: str, table: pa.Table, threshold: int) -> tuple[pa.Table, Chunk]:
    store, _ = _open(folder)
    path = next(p for p in table.column("path").to_pylist() if p is not None)
    with store.open_input_file(path) as file:
        rows = pq.read_table(file)
    return rows, Chunk(rows.column("text").combine_chunks().cast(pa.binary()), threshold)


def _survivors(chunk: Chunk, table: pa.Table, length: int, bits: int) -> tuple[np.ndarray, ...]:
    """What is left of a chunk after the answers of the last round, as ranges."""
    rows = list(zip(*(table.column(c).to_pylist() for c in ("shard", "ranks", "bits")), strict=True))
    for shard, living, _ in rows:
        if shard == -1 and living is not None:
            chunk.revive(living)
    return chunk.keep(*chunk.samples(length), {shard: answer for shard, _, answer in rows if answer is not None}, bits)


def _next_round(folder: str, threshold: int, length: int, following: int, bits: int):
    def ask(table: pa.Table) -> pa.Table:
        _, chunk = _chunk_of(folder, table, threshold)
        _survivors(chunk, table, length, bits)
        _, _, ranks, _ = chunk.samples(following)
        return pa.Table.from_batches([_messages(table.column("chunk")[0].as_py(), None, chunk.living(), np.unique(ranks), bits)])

    return ask


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64), pa.int64())


def _first_of(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Which rows are the first of their pair."""
    order = np.lexsort((two, one))
    one, two = one[order], two[order]
    first = np.zeros(len(order), bool)
    first[order[np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])])[: len(order)]]] = True
    return first


def _rows(chunk: Chunk, rows: pa.Table, number: int, at: np.ndarray, spans: np.ndarray, one: np.ndarray, two: pa.Array, sure: np.ndarray) -> pa.Table:
    """Ranges of positions with two ranks, the number of their chunk, and the id and tie of their text.

    Ranges that are sure and adjoin travel as one, with the ranks of the first.
    """
    adjoins = np.concatenate([[False], sure[1:] & sure[:-1] & (at[1:] == at[:-1] + spans[:-1])])[: len(at)]
    heads = np.flatnonzero(~adjoins)
    spans = np.add.reduceat(spans, heads) if len(heads) else spans
    at, text = at[heads], pa.array(np.searchsorted(chunk.ends, at[heads], side="right"))
    columns = {"one": _signed(one[heads]), "two": two.take(pa.array(heads)), "sure": pa.array(sure[heads]), "chunk": pa.array(np.full(len(at), number), pa.int64())}
    columns |= {"at": pa.array(at, pa.int32()), "n": pa.array(spans, pa.int32())}
    return pa.table(columns | {c: rows.column(c).combine_chunks().take(text) for c in ("id", "tie")})


def _contexts(folder: str, threshold: int, length: int, bits: int):
    """Ranges that share a sample, with the rank of the sample and that of all the bytes the range's strings reach.

    Of ranges with equal bytes in a chunk the first goes on; the positions of the others are sure to repeat.
    """

    def ranges(table: pa.Table) -> pa.Table:
        rows, chunk = _chunk_of(folder, table, threshold)
        firsts, lasts, ranks, whole = _survivors(chunk, table, length, bits)
        number = table.column("chunk")[0].as_py()
        return _rows(chunk, rows, number, firsts, lasts - firsts + 1, ranks, _signed(whole), ~_first_of(ranks, whole))

    return ranges


def _told_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted ranges: ``sure`` where the range before has the same ranks; else it goes on if its sample's rank occurs again.

    The first and the last rank of a partition may occur in the next one too, so both go on.
    """
    before, held, meets = None, None, True
    for batch in batches:
        # without what the schema says beyond names and types
        batch = pa.RecordBatch.from_arrays(batch.columns, batch.schema.names)
        ones, twos = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("one", "two"))
        if not len(ones):
            continue
        same = np.concatenate([[before == (ones[0], twos[0])], (ones[1:] == ones[:-1]) & (twos[1:] == twos[:-1])])
        before = (ones[-1], twos[-1])
        if same.any():
            twice = batch.filter(pa.array(same))
            columns = [pa.array(np.ones(twice.num_rows, bool)) if c == "sure" else twice.column(c) for c in batch.schema.names]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)
        fresh = batch.filter(pa.array(~same))
        if not fresh.num_rows:
            continue
        heads = fresh.column("one").to_numpy(zero_copy_only=False)
        if held is not None:
            heads = np.concatenate([[held.column("one")[0].as_py()], heads])
            fresh = pa.Table.from_batches([held, fresh]).combine_chunks().to_batches()[0]
        alike = heads[1:] == heads[:-1]
        # the last one waits for the next batch
        goes = np.concatenate([[meets], alike])[:-1] | alike
        meets = bool(alike[-1]) if len(alike) else meets
        if goes.any():
            yield fresh.slice(0, fresh.num_rows - 1).filter(pa.array(goes))
        held = fresh.slice(fresh.num_rows - 1)
    if held is not None:
        yield held


def _positions(folder: str, threshold: int, length: int):
    """The positions of ranges, each with the pair of ranks that make up its string; repeated ones of a chunk are sure."""

    def spread(table: pa.Table) -> pa.Table:
        rows, chunk = _chunk_of(folder, table, threshold)
        asked = table.filter(pc.is_valid(table.column("at")))
        firsts, spans = (asked.column(c).to_numpy().astype(np.int64) for c in ("at", "n"))
        chunk.alive = chunk.covered(firsts, firsts + spans)
        at, one, two = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        for places, data, alive in chunk.blocks():
            own = np.flatnonzero(alive)
            ranks = ranks_of(data, length)
            at.append(places[own])
            one.append(ranks[own])
            two.append(ranks[own + threshold - length])
        at, one, two = (np.concatenate(x) for x in (at, one, two))
        half = pa.array((two & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32), pa.int32())
        return _rows(chunk, rows, table.column("chunk")[0].as_py(), at, np.ones(len(at), np.int64), one, half, ~_first_of(one, two))

    return spread


def _leave(folder: str, threshold: int):
    """The texts of a chunk without the bytes that the strings from its removed positions cover."""

    def leave(table: pa.Table) -> pa.Table:
        rows, chunk = _chunk_of(folder, table, threshold)
        removed = table.filter(pc.is_valid(table.column("at")))
        at, spans = (removed.column(c).to_numpy().astype(np.int64) for c in ("at", "n"))
        gone = chunk.covered(at, at + spans + threshold - 1)
        texts, cuts = [], []
        for start, end in zip(chunk.starts.tolist(), chunk.ends.tolist(), strict=True):
            own = gone[start:end]
            if not own.any():
                texts.append(chunk.data[start:end].tobytes())
                cuts.append([])
                continue
            texts.append(chunk.data[start:end][~own].tobytes())
            edges = np.flatnonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]])))
            cuts.append([{"start": a, "length": b - a} for a, b in edges.reshape(-1, 2).tolist()])
        spans_kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
        columns = {"id": rows.column("id"), "n_bytes": pa.array(chunk.ends - chunk.starts, pa.int64())}
        return pa.table(columns | {"spans": pa.array(cuts, spans_kind), "kept": pa.array(texts, pa.binary())})

    return leave


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD, first: int = FIRST, chunk_bytes: int = CHUNK
) -> DataFrame:
    """One row per input row: id, n_bytes, spans (start, length of every removed stretch of bytes), kept (the other bytes).

    A byte is removed if a string of ``threshold`` bytes covers it that also starts earlier: in a text
    of a smaller id, or earlier in the same text, overlapping or not. Strings do not cross texts and are
    compared as the texts came. A null text is empty, null ids come last; texts of equal ids go by their hash,
    equal ones in any order, which gives the same rows. Other columns are ignored, whatever their
    names; an empty table gives an empty result.

    Suffix arrays by prefix doubling sort all positions by pairs of ranks of strings half as long. Here
    the ranks are 64-bit fingerprints, and positions leave as soon as their rank is unique:

    1. Texts are written in chunks. Ranks double within a chunk up to ``first`` bytes. Every string is
       represented by one of its substrings (``Chunk.samples``), about one of 30 positions. Shards compare
       the sampled ranks of all chunks and answer with a bit for each. This repeats at twice the length.
    2. Ranges of positions with the same sample are sorted by its rank and that of all their bytes. Of equal
       ranges only the first goes on, and only where another range has the same sample.
    3. What is left is sorted by the pair of ranks, at the offset that makes ``threshold`` bytes, then by id and
       place. All positions of a pair but the first start a removed string.

    Every chunk sends a rank or pair once, so a string that a third of the texts hold is sorted as often as there
    are chunks. A worker holds one chunk: ``chunk_bytes``, or one longer text (below 2 GB).
    """
    rows = in_small_batches(docs).select(named(id_col).alias("id"), named(text_col).cast("string").alias("text"))
    kind, folder = dict(rows.dtypes)["id"], new_folder(docs.sparkSession, "suffix-chunks")
    tied = rows.select("id", text_key(F.col("text")).bitwiseAND(2**31 - 1).cast("int").alias("tie"), "text")
    lengths = lengths_of(threshold, first)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(3, (total // (threshold - lengths[0] + 1) * 2 // RANKS_PER_SHARD).bit_length())
    messages = materialise(tied.mapInArrow(_cut(folder, threshold, lengths[0], bits, chunk_bytes), MESSAGE), "suffix-ranks")
    roster = messages.where("path is not null").select("chunk", "path")
    tasks = max(1, min(MOST_TASKS, 2 * roster.count()))

    def per_chunk(more: DataFrame, work, schema: str) -> DataFrame:
        """``work`` on every chunk, with the rows of ``more`` that name it."""
        both = roster.unionByName(more, allowMissingColumns=True)
        return both.repartition(tasks, "chunk").groupBy("chunk").applyInArrow(work, schema)

    for i, length in enumerate(lengths):
        found = messages.where("shard >= 0").select("chunk", "shard", "ranks").groupBy("shard").applyInArrow(_repeated, ANSWER)
        found = materialise(found, "suffix-repeated")
        answers = messages.where("shard < 0").select("chunk", "shard", "ranks").unionByName(found, allowMissingColumns=True)
        if i + 1 < len(lengths):
            messages = materialise(per_chunk(answers, _next_round(folder, threshold, length, lengths[i + 1], bits), MESSAGE), "suffix-ranks")
    fields = f"sure boolean, chunk long, at int, n int, id {kind}, tie int"
    ranges = materialise(per_chunk(answers, _contexts(folder, threshold, lengths[-1], bits), f"one long, two long, {fields}"), "suffix-ranges")
    in_order = [F.col("id").asc_nulls_last(), F.col("tie"), F.col("chunk"), F.col("at")]
    ranked = ranges.where("not sure").repartitionByRange("one", "two").sortWithinPartitions("one", "two", *in_order)
    ranked = materialise(ranked.mapInArrow(_told_apart, f"one long, two long, {fields}"), "suffix-ranked")
    pairs = per_chunk(ranked.where("not sure").select("chunk", "at", "n"), _positions(folder, threshold, lengths[-1]), f"one long, two int, {fields}")
    by_pair = Window.partitionBy("one", "two", "sure").orderBy(*in_order)
    again = pairs.withColumn("rank", F.row_number().over(by_pair)).where("sure or rank > 1")
    removed = again.unionByName(ranges.where("sure"), allowMissingColumns=True).unionByName(ranked.where("sure"), allowMissingColumns=True)
    spans = "array<struct<start: bigint, length: bigint>>"
    return per_chunk(removed.select("chunk", "at", "n"), _leave(folder, threshold), f"id {kind}, n_bytes long, spans {spans}, kept binary")
