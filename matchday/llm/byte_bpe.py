"""Byte-level BPE by overlapping chunks: pre-tokenise in parallel, stitch, encode the pieces, decode bytes."""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
import tiktoken
from pyspark.sql import DataFrame, functions as F

from matchday.llm.common import in_small_batches, named, with_fields

#: Characters of a chunk, and how far each reaches into the next.
CHUNK, OVERLAP = 32_768, 512
#: A match ends for certain where this many characters after it are known: the longest contraction looks two ahead.
MARGIN = 2
#: Pieces whose ids a worker remembers; beyond, it starts anew.
REMEMBERED = 100_000


class Pieces(dict):
    """Ids of pieces as they are met."""

    def __init__(self, encoding: tiktoken.Encoding):
        super().__init__()
        self.encode = encoding.encode_ordinary

    def __missing__(self, piece: str) -> array:
        ids = array("i", self.encode(piece))
        if len(self) >= REMEMBERED:
            self.clear()
        if len(piece) <= 64:
            self[piece] = ids
        return ids


class Codec:
    """A rank file with its pattern. The file is read where it is used; it has to exist on every worker."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.split = regex.compile(pattern).findall
        self.pieces = Pieces(tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}))
        size = max(ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def ids(self, pieces: list[str]) -> array:
        return array("i", chain.from_iterable(map(self.pieces.__getitem__, pieces)))

    def decode(self, ids: np.ndarray) -> bytes:
        """The raw bytes of the tokens, one after another."""
        out = []
        for at in range(0, len(ids), 1 << 18):
            part = ids[at : at + (1 << 18)]
            lengths = self.lengths[part]
            first = np.cumsum(lengths) - lengths
            out.append(self.bytes[np.repeat(self.starts[part] - first, lengths) + np.arange(int(lengths.sum()))].tobytes())
        return b"".join(out)


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def chunks_of(text: str, size: int = CHUNK, overlap: int = OVERLAP) -> list[tuple[int, str]]:
    """(start, text) of each chunk: ``size`` characters and the first ``overlap`` of the next."""
    return [(at, text[at : at + size + overlap]) for at in range(0, max(1, len(text)), size)]


def _ends(start: int, pieces: list[str]) -> np.ndarray:
    return start + np.cumsum(np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)))


def stitched(chunks: list[tuple[int, str, list[str]]], split) -> Iterator[list[str]]:
    """The pieces of the whole text, chunk after chunk, from (start, text, pieces) of each chunk.

    Matches depend only on what follows them, so once two chunks share a boundary they agree from there
    on. The first chunk starts on a boundary. Its matches hold up to the first boundary, past the start
    of the next chunk, that the next has too; from there the next is right. A match counts only where
    MARGIN characters after it are known. Where a pair of chunks shares no boundary, the rest of the
    first is matched again together with the next, twice as many chunks each time.
    """
    queue = list(reversed(chunks))
    start, text, pieces = queue.pop()
    true_from, joined = start, 1
    while True:
        ends = _ends(start, pieces)
        low = int(np.searchsorted(ends, true_from, side="right"))  # the first piece that ends after true_from
        if not queue:
            yield pieces[low:]
            return
        sure = ends[: int(np.searchsorted(ends, start + len(text) - MARGIN, side="right"))]
        next_start, next_text, next_pieces = queue[-1]
        next_ends = _ends(next_start, next_pieces)
        if len(queue) > 1:
            next_ends = next_ends[: int(np.searchsorted(next_ends, next_start + len(next_text) - MARGIN, side="right"))]
        shared = np.intersect1d(sure, np.append(next_start, next_ends))
        shared = shared[shared >= max(next_start, true_from)]
        if len(shared):
            yield pieces[low : int(np.searchsorted(ends, shared[0], side="right"))]
            true_from, joined = int(shared[0]), 1
            start, text, pieces = queue.pop()
            continue
        last = max(true_from, int(sure[-1]) if len(sure) else true_from)
        yield pieces[low : int(np.searchsorted(ends, last, side="right"))]
        known = [text[last - start :]]
        end = start + len(text)
        for _ in range(min(joined, len(queue))):
            at, more, _unused = queue.pop()
            known.append(more[end - at :])
            end = max(end, at + len(more))
        start, true_from, text, joined = last, last, "".join(known), joined * 2
        pieces = split(text)


def _list_column(parts: list[array]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    values = np.frombuffer(b"".join(p.tobytes() for p in parts), dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))


def _encode_short(path: str, pattern: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = codec(path, pattern)
        for batch in batches:
            for at in range(0, max(1, batch.num_rows), 1000):
                some = batch.slice(at, 1000)
                # one chunk holds the text, so all its matches stand
                found = [by.ids(by.split(t or "")) for t in some.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([some.column("row"), _list_column(found)], ["row", "ids"])

    return encode


def _cut(size: int, overlap: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                parts = chunks_of(batch.column("text")[i].as_py(), size, overlap)
                for at in range(0, len(parts), 64):
                    some = parts[at : at + 64]
                    first = batch.column("row").slice(i, 1) if at == 0 else pa.nulls(0, batch.column("row").type)
                    row = pa.concat_arrays([first, pa.nulls(len(some) - len(first), first.type)])
                    keys = pa.array([batch.column("key")[i].as_py()] * len(some), pa.int64())
                    columns = [row, keys, pa.array([s for s, _ in some], pa.int64()), pa.array([t for _, t in some], pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, ["row", "key", "start", "chunk"])

    return cut


def _split_chunks(path: str, pattern: str):
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = codec(path, pattern)
        for batch in batches:
            ends = [_ends(0, by.split(t)).astype("<i4").tobytes() for t in batch.column("chunk").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ends, pa.binary())], [*batch.schema.names, "ends"])

    return split


def _stitch(path: str, pattern: str):
    def stitch(table: pa.Table) -> pa.Table:
        by = codec(path, pattern)
        table = table.sort_by("start")
        chunks = []
        for start, text, ends in zip(table["start"].to_pylist(), table["chunk"].to_pylist(), table["ends"].to_pylist(), strict=True):
            edges = [0, *np.frombuffer(ends, "<i4").tolist()]
            chunks.append((start, text, [text[a:b] for a, b in zip(edges, edges[1:], strict=False)]))
        ids = array("i")
        for pieces in stitched(chunks, by.split):
            ids.extend(by.ids(pieces))
        return pa.Table.from_arrays([table["row"].slice(0, 1), _list_column([ids])], ["row", "ids"])

    return stitch


def encode(
    docs: DataFrame, path: str, pattern: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), size: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """The columns ``keep`` and ``ids`` (array of int) for every row; other columns are ignored.

    Texts longer than ``size`` are cut into overlapping chunks, which are pre-tokenised by any task;
    then one task per text stitches them and encodes the pieces. A shorter text is its own only chunk
    and does not move. A null or empty text has no ids. Rows that repeat are encoded each, an empty
    table gives an empty result.
    """
    text = named(text_col).cast("string")
    rows = in_small_batches(docs).select(F.struct(*[named(c) for c in keep]).alias("row"), text.alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    is_long = F.length(F.coalesce("text", F.lit(""))) > size
    short = rows.where(~is_long).mapInArrow(_encode_short(path, pattern), f"row {kind}, ids array<int>")
    chunks = rows.where(is_long).withColumn("key", F.monotonically_increasing_id())
    chunks = chunks.mapInArrow(_cut(size, overlap), f"row {kind}, key long, start long, chunk string").repartition("key", "start")
    split = chunks.mapInArrow(_split_chunks(path, pattern), f"row {kind}, key long, start long, chunk string, ends binary")
    long = split.groupBy("key").applyInArrow(_stitch(path, pattern), f"row {kind}, ids array<int>")
    return short.union(long).select("row.*", "ids")


def decode(encoded: DataFrame, path: str, pattern: str, ids_col: str = "ids", into: str = "decoded") -> DataFrame:
    """``encoded`` plus the bytes its ids stand for; null ids give no bytes."""
    encoded = encoded.select(*[named(c) for c in encoded.columns if c != into])

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = codec(path, pattern)
        for batch in batches:
            for at in range(0, max(1, batch.num_rows), 1000):
                some = batch.slice(at, 1000)
                lists = some.column(some.schema.get_field_index(ids_col))
                values = np.asarray(lists.flatten().to_numpy(zero_copy_only=False), dtype=np.int64)
                edges = np.concatenate([[0], np.cumsum(np.asarray(pa.compute.fill_null(pa.compute.list_value_length(lists), 0), dtype=np.int64))])
                found = [by.decode(values[a:b]) for a, b in zip(edges, edges[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(found, pa.binary())], [*some.schema.names, into])

    return encoded.mapInArrow(decoded, with_fields(encoded, f"`{into}` binary"))
