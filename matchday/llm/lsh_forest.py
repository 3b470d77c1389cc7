"""Near-duplicate join on word shingles: a MinHash LSH forest finds candidates, sets verify them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from matchday.llm.common import components, in_small_batches, leave_one, named, text_key
from matchday.workspace import materialise

#: Words of a shingle, and the least Jaccard similarity of a link.
SHINGLE, SIMILARITY = 5, 0.8
#: Tries of the forest, minima along a trie, and the probability with which a pair at SIMILARITY must be found.
TREES, DEPTH, RECALL = 20, 8, 0.999
#: Bytes of a digit of a path, and of a path: the number of its trie, then a digit for each minimum.
DIGIT = 2
PATH = DIGIT * (1 + DEPTH)
#: Texts that one task compares with as many others. Larger groups of candidates are compared block by block.
BLOCK = 2048
#: Shingles whose minima are taken at a time.
SLICE = 1 << 13

_draw = np.random.default_rng(20240229)
_TURNS = _draw.integers(1, 2**63, (TREES * DEPTH, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _draw.integers(0, 2**63, (TREES * DEPTH, 1), dtype=np.uint64)
_PLACES = _draw.integers(1, 2**63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
del _draw


def recall_at(depth: int, similarity: float = SIMILARITY, trees: int = TREES) -> float:
    """The probability that texts of this similarity share a prefix of ``depth`` minima in some trie."""
    return 1 - (1 - similarity**depth) ** trees


def depth_for(recall: float = RECALL, similarity: float = SIMILARITY) -> int:
    """Shortens the prefix from the whole trie until a pair at ``similarity`` is found with ``recall``."""
    depth = DEPTH
    while depth > 1 and recall_at(depth, similarity) < recall:
        depth -= 1
    return depth


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None) -> np.ndarray:
    """The set of shingles of a text as ascending 64-bit hashes.

    Words are runs of characters other than space and U+0009 to U+000D, in lower case. A text of fewer
    than SHINGLE words is one shingle, a text without words has none.
    """
    words = (text or "").lower().encode("utf-8", "replace").split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(SHINGLE, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        total = total + _mixed(hashes[i : i + len(total)] * _PLACES[i])
    return np.unique(_mixed(total))


def signature(shingle_set: np.ndarray) -> np.ndarray:
    """The minimum of each permutation over the set."""
    least = np.full(TREES * DEPTH, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingle_set), SLICE):
        values = _TURNS * shingle_set[None, at : at + SLICE] + _SHIFTS
        np.minimum(least, (values >> np.uint64(20)).min(1), out=least)
    return least


def paths(minima: np.ndarray) -> np.ndarray:
    """The path of a signature in each trie, a row of digits: the number of the trie, then 16 bits of each minimum."""
    digits = (_mixed(minima) >> np.uint64(48)).reshape(TREES, DEPTH)
    return np.column_stack([np.arange(TREES, dtype=np.uint64), digits]).astype(">u2")


def has_room(size: int, similarity: float = SIMILARITY) -> bool:
    """Whether a set of this size can be similar to another than itself: one shingle more must still do."""
    return size >= similarity * (size + 1) - 1e-9


def _fingerprint(shingle_set: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(shingle_set.tobytes()) if len(shingle_set) else None


def _tag(similarity: float):
    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, max(1, batch.num_rows), 1000):
                some = batch.slice(at, 1000)
                sets = [shingles(t) for t in some.column("text").to_pylist()]
                found = [paths(signature(s)).tobytes() if len(s) and has_room(len(s), similarity) else None for s in sets]
                columns = [some.column("id"), some.column("key"), pa.array([_fingerprint(s) for s in sets], pa.binary()), pa.array(found, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "key", "print", "paths"])

    return tag


def climbed(digits: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """(head, depth) of each of the sorted paths: the row it is tied to, and over how many minima.

    A path shares its longest prefix with the one before it, and is tied to the first path with that
    prefix; only this head goes on to shorter prefixes for it, until less than ``shortest`` minima are
    left. So all paths below a node of that depth are tied together, each by its longest match. The
    head of a path that is tied to none is itself, at depth 0.
    """
    places = np.arange(len(digits))
    same = np.zeros(len(digits), np.int64)
    same[1:] = np.cumprod(digits[1:] == digits[:-1], axis=1).sum(1)
    head, depth = places.copy(), np.maximum(same - 1, 0)
    depth[depth < shortest] = 0
    for d in range(shortest, DEPTH + 1):
        begins = np.maximum.accumulate(np.where(same < d + 1, places, 0))
        head = np.where(depth == d, begins, head)
    return head, depth


def _climb(shortest: int):
    def climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(text: list, head: list, depth: np.ndarray, part: int | None, first: bytes | None, last: bytes | None) -> pa.RecordBatch:
            columns = [pa.array(text, pa.binary()), pa.array(head, pa.binary()), pa.array(depth, pa.int32())]
            columns += [pa.array([part] * len(text), pa.int32()), pa.array([first] * len(text), pa.binary()), pa.array([last] * len(text), pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["text", "head", "depth", "part", "first", "last"])

        # the heads above the last path go on to the next batch, and the last path itself
        kept: list[tuple[bytes, bytes]] = []
        first = None
        for batch in batches:
            if not batch.num_rows:
                continue
            ahead = len(kept)
            path = [p for p, _ in kept] + batch.column("path").to_pylist()
            text = [t for _, t in kept] + batch.column("print").to_pylist()
            first = first or (path[0], text[0])
            digits = np.frombuffer(b"".join(path), ">u2").reshape(len(path), 1 + DEPTH)
            head, depth = climbed(digits, shortest)
            new = np.flatnonzero(depth)
            new = new[new >= ahead]
            yield rows([text[i] for i in new], [text[i] for i in head[new]], depth[new], None, None, None)
            shared = np.cumprod(digits == digits[-1], axis=1).sum(1)
            begins = {int(np.argmax(shared >= d + 1)) for d in range(shortest, DEPTH + 1)}
            kept = [(path[i], text[i]) for i in sorted(begins | {len(path) - 1})]
        if first:
            yield rows([first[1]], [kept[-1][1]], np.zeros(1, np.int32), TaskContext.get().partitionId(), first[0], kept[-1][0])

    return climb


def tied(texts: DataFrame, shortest: int) -> DataFrame:
    """(a, b): prints of ``texts`` (print, paths) that share at least ``shortest`` minima in some trie.

    One sort lays out all tries: equal prefixes are neighbours, and :func:`climbed` ties each path within
    its partition. A node that holds many texts is cut by the sort like any other; where a node goes
    on in the next partition, its last path there and its first path here are tied.
    """
    tree = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    entries = texts.where("paths is not null").select("print", "paths", tree)
    entries = entries.select(F.substring("paths", F.col("tree") * PATH + 1, F.lit(PATH)).alias("path"), "print")
    found = entries.orderBy("path", "print").mapInArrow(_climb(shortest), "text binary, head binary, depth int, part int, first binary, last binary")
    found = materialise(found, "near-tries")
    # a row for each task of the sort
    order = Window.orderBy("part")
    ends = found.where("part is not null").select("text", "first", F.lag("last").over(order).alias("before"), F.lag("head").over(order).alias("other"))
    node = [F.substring(c, 1, DIGIT * (1 + shortest)) for c in ("first", "before")]
    stitched = ends.where(node[0] == node[1]).select("text", "other")
    return found.where("depth > 0").select(F.col("text").alias("a"), F.col("head").alias("b")).union(stitched)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [s.tobytes() for s in map(shingles, batch.column("text").to_pylist())]
        rest = [batch.column(c) for c in ("print", "component", "weight", "blocks")]
        yield pa.RecordBatch.from_arrays([*rest, pa.array(found, pa.binary())], ["print", "component", "weight", "blocks", "set"])


def linked(sets: list[np.ndarray], side: np.ndarray | None = None, similarity: float = SIMILARITY) -> Iterator[tuple[int, np.ndarray]]:
    """(i, js): the places js > i whose sets have a Jaccard similarity with set i of at least ``similarity``.

    With ``side`` only pairs of different sides count. Sets are ranked by size. A shingle is looked at
    from its rarest on: of two similar sets each must have one of its first |s| - ceil(similarity |s|) + 1
    shingles in common with the other, so only sets that share one of those are counted against each
    other. The count is over all shingles that any two sets share, so it is exact.
    """
    sizes = np.array([len(s) for s in sets])
    if len(sets) < 2:
        return
    owners = np.repeat(np.arange(len(sets)), sizes)
    _, shingle, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # rarest first within each set
    order = np.lexsort((shingle, times[shingle], owners))
    shingle, owners = shingle[order], owners[order]
    starts = np.cumsum(sizes) - sizes
    within = np.arange(len(owners)) - np.repeat(starts, sizes)
    needed = np.ceil(similarity * sizes - 1e-9).astype(np.int64)
    early = within < np.repeat(sizes - needed + 1, sizes)
    shared = times[shingle] > 1
    # postings of early shingles that are shared, and of all shared shingles
    by_early = np.flatnonzero(early & shared)
    by_early = by_early[np.argsort(shingle[by_early], kind="stable")]
    early_starts = np.searchsorted(shingle[by_early], np.arange(len(times) + 1))
    early_owner = owners[by_early]
    kept = np.flatnonzero(shared)
    kept_shingle, kept_owner = shingle[kept], owners[kept]
    own_starts = np.searchsorted(kept_owner, np.arange(len(sets) + 1))
    marked = np.zeros(len(times), bool)
    for i in range(len(sets)):
        mine = kept_shingle[own_starts[i] : own_starts[i + 1]]
        first = shingle[starts[i] : starts[i] + sizes[i] - needed[i] + 1]
        first = first[times[first] > 1]
        parts = [early_owner[early_starts[x] : early_starts[x + 1]] for x in first]
        if not parts:
            continue
        others = np.unique(np.concatenate(parts))
        others = others[others > i]
        if side is not None:
            others = others[side[others] != side[i]]
        smaller, larger = np.minimum(sizes[others], sizes[i]), np.maximum(sizes[others], sizes[i])
        others = others[smaller >= similarity * larger - 1e-9]
        if not len(others):
            continue
        marked[mine] = True
        lengths = own_starts[others + 1] - own_starts[others]
        firsts = np.cumsum(lengths) - lengths
        where = np.repeat(own_starts[others] - firsts, lengths) + np.arange(int(lengths.sum()))
        common = np.add.reduceat(np.append(marked[kept_shingle[where]], False).astype(np.int64), firsts) * (lengths > 0)
        marked[mine] = False
        found = others[common >= similarity * (sizes[others] + sizes[i] - common) - 1e-9]
        if len(found):
            yield i, found


def _verify(similarity: float):
    def verify(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("print")
        prints = table["print"].to_pylist()
        sets = [np.frombuffer(x, np.uint64) for x in table["set"].to_pylist()]
        weight = table["weight"].to_numpy()
        low, high = key[1].as_py(), key[2].as_py()
        side = None if low == high else table["block"].to_numpy()
        links, root = np.zeros(len(sets), np.int64), np.arange(len(sets))

        def top(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = int(root[i])
            return i

        for i, others in linked(sets, side, similarity):
            links[i] += weight[others].sum()
            links[others] += weight[i]
            tops = {top(int(j)) for j in others} | {top(i)}
            least = min(tops)
            for t in tops:
                root[t] = least
        some = np.flatnonzero(links)
        return pa.table(
            {
                "print": pa.array([prints[i] for i in some], pa.binary()),
                "links": pa.array(links[some], pa.int64()),
                "first": pa.array([prints[top(int(i))] for i in some], pa.binary()),
            }
        )

    return verify


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, key, class_id, n_links, kept, class_key.

    Texts are linked when the Jaccard similarity of their sets of five-word shingles is at least
    ``similarity`` (see :func:`shingles`). ``n_links`` counts the other rows linked directly, copies
    included; ``class_id`` is the smallest id reachable over links and ``kept`` says that a row has it.
    A text without words (null, empty) links with nothing: its class is its own id. Null ids lose to
    others; a class of null ids has a null class_id. Rows that repeat with id and text are kept or
    dropped together (``drop_near_duplicates`` leaves one). Other columns are ignored, whatever their
    names; an empty table gives an empty result. ``key`` is the hash of the text, ``class_key`` names
    the class whatever its ids, and is null without words.

    Rows with equal sets are one text with a weight. Each text is a path in every trie of the forest,
    and the tries lie sorted, so a text stands next to those with which it shares its longest prefix. It
    is tied there, and the first text with that prefix goes on to shorter ones for both, until a pair at
    the threshold is found with ``recall`` (see :func:`climbed`). Texts with so few shingles that no
    other set is similar go no way at all. Whatever is tied together is compared by sets, in blocks of
    BLOCK texts. So no pair is emitted, every pair below a node is compared (and those of tied nodes as
    well), and no text is linked without comparison.
    """
    rows = in_small_batches(docs).select(named(id_col).alias("id"), named(text_col).cast("string").alias("text"))
    kind = dict(rows.dtypes)["id"]
    keyed = rows.withColumn("key", text_key(F.col("text")))
    tagged = materialise(keyed.mapInArrow(_tag(similarity), f"id {kind}, key long, print binary, paths binary"), "near-rows")
    # of each text one row brings its words
    row = F.min(F.struct("id", "key")).alias("row")
    weights = tagged.where("print is not null").groupBy("print").agg(row, F.count("*").alias("weight"), F.min("id").alias("id"), F.min("paths").alias("paths"))
    weights = materialise(weights, "near-texts")
    ties = tied(weights.select("print", "paths"), depth_for(recall, similarity))
    groups = materialise(components(ties, "near-ties").select(F.col("node").alias("print"), "component"), "near-groups")
    blocks = groups.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    wanted = weights.join(groups, "print").join(blocks, "component")
    wanted = wanted.select("print", "component", "weight", "blocks", F.col("row.id").alias("_id"), F.col("row.key").alias("_key"))
    texts = keyed.join(wanted, F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")))
    texts = texts.select("print", "component", "weight", "blocks", "text")
    sets = texts.mapInArrow(_sets, "print binary, component binary, weight long, blocks long, set binary").dropDuplicates(["print"])
    own = F.pmod(F.xxhash64("print"), F.col("blocks"))
    cells = sets.withColumn("block", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    cells = cells.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    found = cells.select("component", "low", "high", "block", "print", "weight", "set").groupBy("component", "low", "high")
    found = materialise(found.applyInArrow(_verify(similarity), "print binary, links long, first binary"), "near-links")
    links = found.groupBy("print").agg(F.sum("links").alias("links"))
    classes = components(found.select(F.col("print").alias("a"), F.col("first").alias("b")), "near-classes")
    of_class = weights.select("print", "id", "weight").join(classes.withColumnRenamed("node", "print"), "print", "left")
    of_class = of_class.withColumn("component", F.coalesce("component", "print")).join(links, "print", "left")
    of_class = materialise(of_class, "near-members")
    least = of_class.groupBy("component").agg(F.min("id").alias("class_id"))
    members = of_class.join(least, "component").select("print", "component", "class_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    joined = tagged.drop("paths").join(members, "print", "left")
    wordless = F.col("print").isNull()
    class_id = F.when(wordless, F.col("id")).otherwise(F.col("class_id"))
    return joined.select(
        "id",
        "key",
        class_id.alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.col("id").eqNullSafe(class_id).alias("kept"),
        F.hex("component").alias("class_key"),
    )


def drop_near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with all its columns and one row of each class: that of its class_id.

    Where several rows have that id, one of those is left. Rows without words all stay.
    """
    found = materialise(near_duplicates(docs, similarity, recall, id_col, text_col), "near-result").where("class_key is not null")
    acts = found.groupBy("class_key", "id", "key").agg(F.min("kept").alias("stays"), F.count("*").alias("n"))
    return leave_one(docs, materialise(acts, "near-acts"), "class_key", id_col, text_col)
