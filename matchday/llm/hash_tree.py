"""Sharding by a tree of weighted hash draws: region, rack, shard."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from matchday.llm.common import named, unit_draw, with_salt
from matchday.workspace import materialise

#: Rows that one task numbers at a time, on average.
ROWS_PER_BLOCK = 4096


@dataclass(frozen=True)
class Node:
    """A subtree: ``name`` is unique among its siblings; a leaf has a ``shard`` and a ``weight`` of its own."""

    name: str
    children: tuple[Node, ...] = ()
    shard: int | None = None
    weight: float = 1.0

    @property
    def total(self) -> float:
        return sum(c.total for c in self.children) if self.children else self.weight

    def leaves(self) -> list[Node]:
        return [x for c in self.children for x in c.leaves()] if self.children else [self]


def even_tree(shards: int, racks_per_region: int = 2, shards_per_rack: int = 2) -> Node:
    """Equal shards in racks, racks in regions, filled in order."""
    leaves = [Node(f"shard{i}", shard=i) for i in range(shards)]
    racks = [Node(f"rack{i}", tuple(leaves[at : at + shards_per_rack])) for i, at in enumerate(range(0, shards, shards_per_rack))]
    regions = [Node(f"region{i}", tuple(racks[at : at + racks_per_region])) for i, at in enumerate(range(0, len(racks), racks_per_region))]
    return Node("root", tuple(regions))


def grown(tree: Node, shard: int, weight: float = 1.0) -> Node:
    """``tree`` with one more shard in a region of its own.

    The weights of the other regions stay as they are, so their draws do too: a row either draws the
    new region or goes where it went before.
    """
    leaf = Node(f"shard{shard}", shard=shard, weight=weight)
    region = Node(f"grown-region{shard}", (Node(f"grown-rack{shard}", (leaf,)),))
    return Node(tree.name, (*tree.children, region))


def shard_of(key: Column, tree: Node) -> Column:
    """The shard of ``key``: at each level every child draws a hash, scaled by its weight; the least wins.

    A child's draw is -ln(u) / weight, where u depends on the key and the child's path alone. So a
    child wins in proportion to its weight, and a change of weight moves rows only into or out of that
    child. A null key is a key like any other. Children without weight draw nothing.
    """

    def choose(node: Node, path: str) -> Column:
        if not node.children:
            return F.lit(node.shard)
        able = [c for c in node.children if c.total > 0]
        inner = [choose(c, f"{path}/{c.name}") for c in able]
        if len(able) == 1:
            return inner[0]
        draws = [-F.log(unit_draw(key, F.lit(f"{path}/{c.name}"))) / F.lit(float(c.total)) for c in able]
        best = F.least(*[F.struct(d.alias("draw"), F.lit(i).alias("child")) for i, d in enumerate(draws)])["child"]
        return F.coalesce(*[F.when(best == i, c) for i, c in enumerate(inner)])

    if not any(x.total > 0 for x in tree.leaves()):
        raise ValueError("the tree has no shard with weight")
    return choose(tree, tree.name).cast("int")


def numbered(rows: DataFrame, order: list[str], shard: str = "shard", id_col: str = "id") -> DataFrame:
    """``rows`` plus ``slot``: 0, 1, 2, ... without gaps within each shard.

    Rows of a shard are dealt by hash to blocks of about ROWS_PER_BLOCK; a block is numbered by itself
    and starts where the blocks before it end. Ids that repeat are dealt by row, so no block is large.
    """
    total = rows.count()
    blocks = max(1, -(-total // (ROWS_PER_BLOCK * max(1, rows.select(shard).distinct().count()))))
    dealt = with_salt(rows, id_col, "_salt").withColumn("_block", F.pmod(F.xxhash64(id_col, "_salt"), F.lit(blocks)))
    dealt = materialise(dealt, "shard-blocks")
    counts = dealt.groupBy(shard, "_block").count()
    before = Window.partitionBy(shard).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(shard, "_block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(shard, "_block").orderBy(id_col, *order, "_salt")
    ranked = dealt.withColumn("_rank", F.row_number().over(within))
    joined = ranked.join(starts, [shard, "_block"])
    return joined.withColumn("slot", F.col("_start") + F.col("_rank") - 1).drop("_block", "_start", "_rank", "_salt")


def place(docs: DataFrame, tree: Node, more: Node | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, size, text_crc32, shard, grown_shard, slot.

    The id alone decides the shard, so texts, ties and other columns (whatever their names) have no
    part in it; rows with equal ids, null included, share a shard. ``size`` is the bytes of the text
    plus 1 (a null text has none), ``grown_shard`` the shard in ``more``, null without it. An empty
    table gives an empty result.
    """
    key = F.coalesce(named(id_col).cast("string"), F.lit("null"))
    text = F.coalesce(named(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        named(id_col).alias("id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        shard_of(key, tree).alias("shard"),
        (shard_of(key, more) if more else F.lit(None).cast("int")).alias("grown_shard"),
    )
    return numbered(materialise(rows, "shard-rows"), ["text_crc32", "size"])
