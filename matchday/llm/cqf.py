"""Exact deduplication: counting quotient filters find repeated fingerprints, bytes decide."""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from matchday.llm.common import in_small_batches, leave_one, named, text_key
from matchday.workspace import materialise

#: Bits of a fingerprint; more only make a routed false alarm rarer, never a result different.
FINGERPRINT_BITS = 48
#: Fingerprints that one merging task holds, on average.
ROWS_PER_SHARD = 1 << 20
DELETED = b" \t\n\x0b\x0c\r"


class CountingQuotientFilter:
    """Counts of fingerprints, kept as quotient bitmap, runs of sorted remainders and counters.

    The high bits of a fingerprint (its quotient) are a position in ``occupied``; the low bits (its
    remainder) stand in the run of that quotient, in ascending order, and ``run_ends`` marks the last
    slot of every run. Slots counted once need no counter; ``counted`` marks those that have one.
    Nothing is approximate: the fingerprints and their counts can be read back, so merging loses nothing.
    """

    def __init__(self, fingerprints: np.ndarray, counts: np.ndarray, bits: int = FINGERPRINT_BITS):
        """From ascending, distinct fingerprints."""
        self.bits = bits
        self.quotient_bits = max(1, int(len(fingerprints)).bit_length())
        self.remainder_bits = bits - self.quotient_bits
        quotients = (fingerprints >> np.uint64(self.remainder_bits)).astype(np.int64)
        self.remainders = fingerprints & np.uint64((1 << self.remainder_bits) - 1)
        self.occupied = np.zeros(1 << self.quotient_bits, dtype=bool)
        self.occupied[quotients] = True
        self.run_ends = np.append(quotients[1:] != quotients[:-1], True) if len(quotients) else np.zeros(0, bool)
        self.counted = counts > 1
        self.counters = counts[self.counted].astype(np.uint64)

    @classmethod
    def of(cls, fingerprints: np.ndarray, bits: int = FINGERPRINT_BITS) -> CountingQuotientFilter:
        return cls(*np.unique(fingerprints.astype(np.uint64), return_counts=True), bits)

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        """All fingerprints in ascending order and their counts."""
        runs = np.concatenate([[0], np.cumsum(self.run_ends)[:-1]]).astype(np.int64) if len(self.run_ends) else np.zeros(0, np.int64)
        quotients = np.flatnonzero(self.occupied)[runs].astype(np.uint64)
        counts = np.ones(len(self.remainders), dtype=np.uint64)
        counts[self.counted] = self.counters
        return (quotients << np.uint64(self.remainder_bits)) | self.remainders, counts

    @classmethod
    def merged(cls, filters: list[CountingQuotientFilter]) -> CountingQuotientFilter:
        """The filter of all their rows: equal quotients meet, their sorted remainders interleave, counts add."""
        parts = [f.items() for f in filters]
        keys = np.concatenate([k for k, _ in parts])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], np.concatenate([c for _, c in parts])[order]
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        sums = np.add.reduceat(counts, starts) if len(keys) else counts
        return cls(keys[starts], sums, filters[0].bits if filters else FINGERPRINT_BITS)

    def to_bytes(self) -> bytes:
        width = (self.remainder_bits + 7) // 8
        slots = self.remainders.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
        head = struct.pack("<BBQQ", self.bits, self.quotient_bits, len(self.remainders), len(self.counters))
        bitmaps = [np.packbits(x).tobytes() for x in (self.occupied, self.run_ends, self.counted)]
        return b"".join([head, *bitmaps, slots.tobytes(), self.counters.astype("<u8").tobytes()])

    @classmethod
    def from_bytes(cls, data: bytes) -> CountingQuotientFilter:
        bits, quotient_bits, slots, counters = struct.unpack_from("<BBQQ", data)
        at, found = struct.calcsize("<BBQQ"), cls.__new__(cls)
        found.bits, found.quotient_bits, found.remainder_bits = bits, quotient_bits, bits - quotient_bits
        for name, size in (("occupied", 1 << quotient_bits), ("run_ends", slots), ("counted", slots)):
            packed = np.frombuffer(data, np.uint8, (size + 7) // 8, at)
            setattr(found, name, np.unpackbits(packed, count=size).astype(bool))
            at += len(packed)
        width = (found.remainder_bits + 7) // 8
        wide = np.zeros((slots, 8), np.uint8)
        wide[:, :width] = np.frombuffer(data, np.uint8, slots * width, at).reshape(slots, width)
        found.remainders = wide.reshape(-1).view("<u8").astype(np.uint64)
        found.counters = np.frombuffer(data, "<u8", counters, at + slots * width).astype(np.uint64)
        return found


def _normalised(texts: pa.Array) -> list[bytes]:
    return [(x or b"").translate(None, DELETED) for x in texts.cast(pa.binary()).to_pylist()]


def _tag(with_text: bool):
    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, max(1, whole.num_rows), 500):
                batch = whole.slice(at, 500)
                texts = _normalised(batch.column("text"))
                digests = [hashlib.sha256(x) for x in texts]
                marks = [int.from_bytes(d.digest()[:8], "big") >> (64 - FINGERPRINT_BITS) for d in digests]
                hexes = pa.array([d.hexdigest() for d in digests], pa.string())
                if with_text:
                    columns = {"mark": pa.array(marks, pa.int64()), "sha": hexes, "bytes": pa.array(texts, pa.binary())}
                else:
                    columns = {
                        "id": batch.column("id"),
                        "key": batch.column("key"),
                        "length": pc.cast(pc.fill_null(pc.utf8_length(batch.column("text")), 0), pa.int64()),
                        "mark": pa.array(marks, pa.int64()),
                        "sha": hexes,
                    }
                yield pa.RecordBatch.from_pydict(columns)

    return tag


def _filters(shard_bits: int):
    low = FINGERPRINT_BITS - shard_bits

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.asarray(b.column("mark").to_numpy(zero_copy_only=False), dtype=np.uint64) for b in batches]
        marks = np.sort(np.concatenate(kept)) if kept else np.zeros(0, np.uint64)
        shards = (marks >> np.uint64(low)).astype(np.int64)
        edges = np.flatnonzero(np.append(True, shards[1:] != shards[:-1])) if len(marks) else np.zeros(0, np.int64)
        names = [int(shards[i]) for i in edges]
        built = [CountingQuotientFilter.of(part & np.uint64((1 << low) - 1), low).to_bytes() for part in np.split(marks, edges[1:])[: len(names)]]
        yield pa.RecordBatch.from_pydict({"shard": pa.array(names, pa.int64()), "filter": pa.array(built, pa.binary())})

    return build


def _repeated(shard_bits: int):
    low = FINGERPRINT_BITS - shard_bits

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        parts = [CountingQuotientFilter.from_bytes(x) for x in table.column("filter").to_pylist()]
        marks, counts = CountingQuotientFilter.merged(parts).items()
        marks = (marks | np.uint64(key[0].as_py() << low))[counts > 1].astype(np.int64)
        return pa.table({"mark": pa.array(marks, pa.int64())})

    return merge


def exact_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, key, keep_id, group_size, kept, text_sha256.

    Texts are equal when the same bytes remain after deleting space and U+0009 to U+000D; a null text
    counts as empty. Of equal texts the row with the most code points stays, then the smallest id; a
    null id loses such ties, and is the keep_id only where all ids of the longest are null. Rows that
    repeat with the same id and text are kept or dropped together (``drop_copies`` leaves one of them).
    Other columns are ignored, whatever their names; an empty table gives an empty result. ``key`` is
    the hash of the unchanged text, which names a row together with its id.

    Every partition builds filters of its fingerprints, cut by their highest bits into shards; each
    shard merges its filters. A fingerprint counted once is unique. The others route their documents to
    the verification, which groups by the bytes themselves. A copy adds a count to a filter and a
    partial sum to a group, so no group is ever gathered.
    """
    rows = in_small_batches(docs).select(named(id_col).alias("id"), named(text_col).cast("string").alias("text"))
    kind = dict(rows.dtypes)["id"]
    keyed = rows.withColumn("key", text_key(F.col("text")))
    tagged = materialise(keyed.mapInArrow(_tag(False), f"id {kind}, key long, length long, mark long, sha string"), "exact-rows")
    shard_bits = max(4, (tagged.count() // ROWS_PER_SHARD).bit_length())
    filters = tagged.select("mark").mapInArrow(_filters(shard_bits), "shard long, filter binary")
    marks = materialise(filters.groupBy("shard").applyInArrow(_repeated(shard_bits), "mark long"), "exact-marks")
    texts = rows.select("text").mapInArrow(_tag(True), "mark long, sha string, bytes binary").join(marks, "mark")
    verified = texts.groupBy("sha", "bytes").count().groupBy("sha").agg(F.sum("count").alias("group_size"), F.count("*").alias("_texts"))
    collision = F.raise_error(F.concat(F.lit("different bytes under one digest: "), "sha"))
    verified = verified.withColumn("group_size", F.when(F.col("_texts") > 1, collision.cast("long")).otherwise(F.col("group_size")))
    routed = tagged.join(marks, "mark", "left_semi")
    longest = routed.groupBy("sha").agg(F.max("length").alias("most"))
    first = routed.join(longest, "sha").where("length = most").groupBy("sha", "most").agg(F.min("id").alias("first"))
    groups = materialise(first.join(verified, "sha").select("sha", "most", "first", "group_size").where("group_size > 1"), "exact-groups")
    joined = tagged.join(groups, "sha", "left")
    alone = F.col("group_size").isNull()
    return joined.select(
        "id",
        "key",
        F.when(alone, F.col("id")).otherwise(F.col("first")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | ((F.col("length") == F.col("most")) & F.col("id").eqNullSafe(F.col("first")))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with all its columns, and of equal texts only the row that stays.

    Of rows that tie with equal ids one is left. Only the rows that leave or tie are joined.
    """
    classes = exact_classes(docs, id_col, text_col).where("group_size > 1")
    acts = classes.groupBy("text_sha256", "id", "key").agg(F.min("kept").alias("stays"), F.count("*").alias("n"))
    return leave_one(docs, materialise(acts, "exact-acts"), "text_sha256", id_col, text_col)
