"""Prefix trie of conversations: sorted shards finish their own nodes, a skeleton of splitter paths joins them."""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from matchday.llm.common import named, unit_draw
from matchday.llm.pivotal import word_count
from matchday.workspace import materialise

#: Conversations of a shard, on average, and the most shards. Shards are read as streams, so they may grow beyond.
ROWS_PER_SHARD, MOST_SHARDS = 1 << 20, 1 << 14
#: Sampled conversations for each splitter, and the turns of a splitter. Both bound what is sent to all tasks: the
#: skeleton has at most MOST_SHARDS * SPLITTER_TURNS nodes of about 100 bytes.
SAMPLES, SPLITTER_TURNS = 16, 32
#: Numbers of a turn in a path: two hashes of role and text, and the words of the text.
WIDTH = 3
#: Ids that travel together to the digest of a node that several shards share.
IDS_PER_BLOCK = 1 << 13
NONE_SHA = hashlib.sha256(b"").hexdigest()


def turn_paths(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, path) of every conversation: WIDTH numbers for each of its turns, in order of the turn, null first.

    A null role or text is an empty one. Equal turn numbers go by role and text, in the order of their
    hashes. Rows without an id belong to no conversation. Texts are hashed before anything moves.
    """
    role, text = (F.coalesce(named(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    hashes = (F.xxhash64(role, text), F.xxhash64(F.lit("second"), text, role))
    rows = turns.where(named(id_col).isNotNull()).select(
        named(id_col).cast("long").alias("conv_id"),
        F.struct(named(turn_col).alias("turn"), F.array(*hashes, word_count(text)).alias("mark")).alias("x"),
    )
    paths = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    return paths.select("conv_id", F.flatten("xs.mark").alias("path"))


def rebuilt(paths: DataFrame, every: int = 20, heads: int = 4) -> DataFrame:
    """Every conversation c with its first h turns from conversation c - c % every; h is the crc32 of the decimal c, modulo ``heads``."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads * WIDTH).cast("int")
    shared = F.slice("path", 1, WIDTH * (heads - 1))
    first = paths.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("_base"), shared.alias("_head"))
    joined = paths.join(first, F.col("conv_id") - F.col("conv_id") % every == F.col("_base"), "left")
    head = F.slice(F.coalesce("_head", F.slice("path", 1, 0)), F.lit(1), h)
    own = F.slice("path", h + 1, F.greatest(F.size("path") - h, F.lit(0)))
    return joined.select("conv_id", F.concat(head, own).alias("path"))


class Skeleton:
    """The trie of the splitters' paths. Nodes are numbered from the root, 0, parents before children."""

    def __init__(self, splitters: list[tuple[list[int], int]]):
        self.splitters = splitters
        self.parent, self.depth, self.words, self.children = [-1], [0], [0], [0]
        self.child: dict[tuple[int, int, int], int] = {}
        for path, _ in splitters:
            at = 0
            for i in range(0, len(path), WIDTH):
                key = (at, path[i], path[i + 1])
                if key not in self.child:
                    self.child[key] = len(self.parent)
                    self.parent.append(at)
                    self.depth.append(self.depth[at] + 1)
                    self.words.append(path[i + 2])
                    self.children.append(0)
                    self.children[at] += 1
                at = self.child[key]

    def above(self, node: int) -> Iterator[int]:
        """The node and all above it."""
        while node >= 0:
            yield node
            node = self.parent[node]


def skeleton_of(paths: DataFrame, rows: int, shards: int) -> Skeleton:
    """Splitters that cut the sorted (path, conv_id) into about ``shards`` equal parts, from a sample of bounded size.

    A splitter longer than SPLITTER_TURNS is cut there and stands before all that begin like it. One that
    is not cut has an id too, so copies of one conversation can be cut as well.
    """
    drawn = paths.where(unit_draw(F.col("conv_id"), F.lit("splitters")) < min(1.0, SAMPLES * shards / max(1, rows)))
    most = SPLITTER_TURNS * WIDTH
    short = drawn.select(F.slice("path", 1, most).alias("path"), F.when(F.size("path") <= most, F.col("conv_id")).otherwise(-(2**63)).alias("conv_id"))
    sample = sorted((list(r.path), r.conv_id) for r in short.limit(4 * SAMPLES * shards).toLocalIterator())
    chosen = [sample[i * len(sample) // shards] for i in range(1, shards)] if sample else []
    return Skeleton([s for s, before in zip(chosen, [None, *chosen], strict=False) if s != before])


def _deal(skeleton: Skeleton):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist(), strict=True)
            shards = pa.array([bisect_right(skeleton.splitters, key) for key in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([shards, batch.column("conv_id"), batch.column("path")], ["shard", "conv_id", "path"])

    return deal


class Node:
    """A node while the sorted rows below it pass."""

    __slots__ = ("conv", "digest", "ends", "kids", "leaves", "n", "saved", "skeleton", "waiting", "words")

    def __init__(self, skeleton: int, words: int):
        self.skeleton, self.words = skeleton, words
        self.n, self.conv, self.kids, self.leaves, self.saved = 0, 2**63, 0, 0, 0
        self.digest, self.ends, self.waiting = None, [], []


#: What a shard gives: finished nodes (0), finished nodes whose parent is in the skeleton (1), its part of a skeleton
#: node (2) and ids of conversations that end in one (3).
FINISHED, BELOW, PART, ENDS = range(4)
FIELDS = [
    ("kind", pa.int32()), ("node", pa.int32()), ("depth", pa.int64()), ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends", pa.string()), ("shard", pa.int32()), ("block", pa.int64()),
]
SPARK_TYPES = {pa.int32(): "int", pa.int64(): "long", pa.string(): "string"}


class Scan:
    """Walks over the sorted rows of a shard with the nodes of the current path, and keeps what is finished."""

    def __init__(self, skeleton: Skeleton, shard: int):
        self.skeleton, self.shard, self.path, self.blocks = skeleton, shard, [], 0
        self.stack, self.out = [Node(0, 0)], []

    def add(self, path: list[int], conv: int) -> None:
        same = 0
        while same < min(len(path), len(self.path)) and path[same : same + WIDTH] == self.path[same : same + WIDTH]:
            same += WIDTH
        self.close(same // WIDTH)
        for i in range(same, len(path), WIDTH):
            above = self.stack[-1].skeleton
            known = self.skeleton.child.get((above, path[i], path[i + 1]), -1) if above >= 0 else -1
            self.stack.append(Node(known, path[i + 2]))
        self.path, end = path, self.stack[-1]
        end.n += 1
        end.conv = min(end.conv, conv)
        if end.skeleton >= 0:
            end.ends.append(str(conv))
            if len(end.ends) >= IDS_PER_BLOCK:
                self.flush(end)
        elif end.digest is None:
            end.digest = hashlib.sha256(str(conv).encode())
        else:
            end.digest.update(b",%d" % conv)

    def flush(self, node: Node) -> None:
        if node.ends:
            self.out.append((ENDS, node.skeleton, None, None, None, 0, 0, 0, 0, ",".join(node.ends), self.shard, self.blocks))
            self.blocks, node.ends = self.blocks + 1, []

    def close(self, depth: int) -> None:
        """Finishes all nodes deeper than ``depth``."""
        while len(self.stack) > depth + 1:
            node, at = self.stack.pop(), len(self.stack)
            above = self.stack[-1]
            if node.skeleton >= 0:
                self.part(node)
                continue
            leaves = node.leaves if node.kids else 1
            saved = node.saved + (node.n - 1) * node.words
            digest = node.digest.hexdigest() if node.digest else NONE_SHA
            self.out += [(FINISHED, None, at + 1, *x[:1], node.conv, *x[1:], None, None) for x in node.waiting]
            own = (node.conv, node.n, node.kids, leaves, saved, digest)
            if above.skeleton >= 0:
                self.out.append((BELOW, above.skeleton, at, node.conv, None, *own[1:], None, None))
            else:
                above.waiting.append(own)
            above.n, above.conv, above.kids = above.n + node.n, min(above.conv, node.conv), above.kids + 1
            above.leaves, above.saved = above.leaves + leaves, above.saved + saved

    def part(self, node: Node) -> None:
        """This shard's part of a skeleton node, without what lies below other skeleton nodes."""
        self.flush(node)
        if node.n:
            self.out.append((PART, node.skeleton, None, node.conv, None, node.n, node.kids, node.leaves, node.saved, None, self.shard, None))

    def end(self) -> None:
        self.close(0)
        self.part(self.stack[0])

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.out, strict=True)) or [()] * len(FIELDS)
        self.out = []
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(columns, FIELDS, strict=True)], [n for n, _ in FIELDS])


def _scan(skeleton: Skeleton):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: Scan | None = None
        for batch in batches:
            for shard, conv, path in zip(*(batch.column(c).to_pylist() for c in ("shard", "conv_id", "path")), strict=True):
                if at is None or at.shard != shard:
                    if at is not None:
                        at.end()
                        yield at.batch()
                    at = Scan(skeleton, shard)
                at.add(path, conv)
                if len(at.out) >= 10_000:
                    yield at.batch()
        if at is not None:
            at.end()
            yield at.batch()

    return scan


def _climb(skeleton: Skeleton):
    """Every row once for each skeleton node that its own is below, or is."""

    def climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                some = batch.slice(i, 1000)
                nodes = [(row, x) for row, node in enumerate(some.column("node").to_pylist()) for x in skeleton.above(node)]
                rows = some.take(pa.array([row for row, _ in nodes], pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array([x for _, x in nodes], pa.int32()), *rows.columns[1:]], rows.schema.names)

    return climb


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of all ids of a node, whose blocks come in order."""
    node, digest, found = None, None, []
    for batch in batches:
        for own, ids in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist(), strict=True):
            if own == node:
                digest.update(b"," + ids.encode())
                continue
            if digest is not None:
                found.append((node, digest.hexdigest()))
            node, digest = own, hashlib.sha256(ids.encode())
    if digest is not None:
        found.append((node, digest.hexdigest()))
    yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in found], pa.int32()), pa.array([d for _, d in found], pa.string())], ["node", "ends"])


def _of_skeleton(found: DataFrame, skeleton: Skeleton) -> DataFrame:
    """The nodes of the skeleton: the shards' parts add up along the paths to the root."""
    spark = found.sparkSession
    parts = found.where(F.col("kind") == PART).groupBy("node").agg(
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.sum("n_children").alias("kids"),
        F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"),
    )
    kids = parts.select("node", "kids")
    sums = ("n_convs long, conv_id long, leaves long, saved long", ["n_convs", "conv_id", "leaves", "saved"])
    climbed = parts.select("node", *sums[1]).mapInArrow(_climb(skeleton), f"node int, {sums[0]}")
    totals = climbed.groupBy("node").agg(
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")
    )
    shape = spark.createDataFrame(
        list(zip(range(len(skeleton.parent)), skeleton.parent, skeleton.depth, skeleton.words, skeleton.children, strict=True)),
        "node int, parent int, depth long, words long, inner long",
    )
    known = materialise(
        totals.join(shape, "node").join(kids, "node", "left").withColumn("n_children", F.col("inner") + F.coalesce("kids", F.lit(0))).drop("kids", "inner"),
        "trie-skeleton",
    )
    own = known.select("node", ((F.col("n_convs") - 1) * F.col("words")).alias("saved"), (F.col("n_children") == 0).cast("long").alias("leaves"))
    more = own.mapInArrow(_climb(skeleton), "node int, saved long, leaves long").groupBy("node").agg(F.sum("saved").alias("more_saved"), F.sum("leaves").alias("more_leaves"))
    # one task for each node: the digest of a list needs it in order
    blocks = found.where(F.col("kind") == ENDS).select("node", "shard", "block", "ends")
    ends = blocks.repartition("node").sortWithinPartitions("node", "shard", "block").select("node", "ends").mapInArrow(_digest, "node int, ends string")
    parents = known.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    joined = known.join(more, "node").join(ends, "node", "left").join(parents, "parent", "left")
    return joined.select(
        "node", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", (F.col("leaves") + F.col("more_leaves")).alias("n_leaves"),
        (F.col("saved") + F.col("more_saved")).alias("saved_tokens"), F.coalesce("ends", F.lit(NONE_SHA)).alias("ends_sha256"),
    )


def prefix_trie(paths: DataFrame, shards: int | None = None) -> DataFrame:
    """One row per distinct prefix of the paths (conv_id, path), from the empty one on.

    ``conv_id`` is the smallest member, a conversation that begins with the prefix; ``parent_conv_id`` that
    of the prefix one turn shorter (null for the root); ``n_convs`` counts members, ``n_children`` the
    prefixes one turn longer, ``n_leaves`` those below (or here) that nothing continues; ``saved_tokens``
    sums, over the prefix and all below it, the words of the last turn times the members but one;
    ``ends_sha256`` is the digest of the ascending decimal ids of the conversations that are the prefix,
    joined by commas. Every id stands for one conversation; an empty table has no nodes, not even a root.

    Splitters from a sample cut the conversations, sorted by path and id, into shards. A prefix that is
    none of a splitter's has all its members in one shard, which finishes it while the sorted rows pass. The
    splitters' prefixes are the skeleton; each shard gives its part of them, and these add up. Copies of one
    conversation are cut by id. A shard's memory is the current path and the finished children of the
    nodes on it. A conversation is one record: its path, 24 bytes for each turn, has to fit into a row.
    """
    paths = materialise(paths.select("conv_id", "path"), "trie-paths")
    rows = paths.count()
    shards = shards or min(MOST_SHARDS, max(int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows // ROWS_PER_SHARD))
    skeleton = skeleton_of(paths, rows, shards)
    dealt = paths.mapInArrow(_deal(skeleton), "shard int, conv_id long, path array<long>").repartition(shards, "shard")
    fields = ", ".join(f"{name} {SPARK_TYPES[kind]}" for name, kind in FIELDS)
    found = materialise(dealt.sortWithinPartitions("shard", "path", "conv_id").mapInArrow(_scan(skeleton), fields), "trie-nodes")
    top = materialise(_of_skeleton(found, skeleton), "trie-top")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    done = found.withColumnRenamed("ends", "ends_sha256")
    # the skeleton has a bounded number of nodes, and one of them may be the parent of most others
    parents = F.broadcast(top.select("node", F.col("conv_id").alias("_parent")))
    below = done.where(F.col("kind") == BELOW).join(parents, "node").withColumn("parent_conv_id", F.col("_parent"))
    return done.where(F.col("kind") == FINISHED).select(*columns).union(below.select(*columns)).union(top.select(*columns))


def conversation_trie(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The :func:`prefix_trie` of conversations as they are, by role and text of their turns; other columns are ignored."""
    return prefix_trie(turn_paths(turns, id_col, turn_col, role_col, text_col))
