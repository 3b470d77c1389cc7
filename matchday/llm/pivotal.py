"""Mixing sources to target weights by pivotal dependent rounding, all in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from matchday.llm.common import WHITE_SPACE, named, text_key, unit_draw, with_copies_numbered
from matchday.workspace import materialise

#: Copy probabilities that one node of the reduction tree combines, on average.
FAN_IN = 32


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{WHITE_SPACE}]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """``sizes`` (source, source_size, ...) plus weight and target.

    Sources in code point order, null last, take the weights in turn. They divide ``share`` of all
    sizes by weight; no target exceeds ``most`` times its source, and the excess goes to the others by
    weight until none is above. That is a common rate per weight. Order the sources by the rate at
    which they are full, and fill those before a place: the rate left for the rest rises as long as
    that fills sources below it and falls afterwards, so the largest is the common one. The table has
    a row per source.
    """
    in_order = Window.orderBy(F.asc_nulls_last("source"))
    turn = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("weight", F.element_at(turn, ((F.row_number().over(in_order) - 1) % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("_cap", F.col("source_size") * F.lit(float(most)))
    by_rate = Window.orderBy(F.col("_cap") / F.col("weight"), F.asc_nulls_last("source"))
    whole = Window.partitionBy()
    before = by_rate.rowsBetween(Window.unboundedPreceding, -1)
    budget = F.least(F.sum("source_size").over(whole) * F.lit(float(share)), F.sum("_cap").over(whole))
    left = budget - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    heavy = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    rated = ranked.withColumn("_rate", left / heavy)
    target = F.least("_cap", F.col("weight") * F.max("_rate").over(whole))
    return rated.withColumn("target", target).drop("_cap", "_rate")


def _fold(level: int) -> Column:
    """One node of the tree: (carry, done) of the array ``open``, whose items are (id, salt, size, mass).

    The carry meets the next item. Mass moves one way or the other until one of the two holds nothing
    or its whole size; the directions are drawn so that neither mass changes in expectation. The item
    that became integral is done, the other is the carry.
    """

    def item(x: Column, mass: Column) -> Column:
        return F.struct(x["id"].alias("id"), x["salt"].alias("salt"), x["size"].alias("size"), mass.alias("mass"))

    def step(acc: Column, b: Column) -> Column:
        a = acc["carry"]
        up = F.least(a["size"] - a["mass"], b["mass"])
        down = F.least(a["mass"], b["size"] - b["mass"])
        rises = unit_draw(F.lit(level), b["id"], b["salt"], a["id"], a["salt"]) * (up + down) < down
        a_full, b_empty = item(a, a["size"]), item(b, F.lit(0.0))
        a_empty, b_full = item(a, F.lit(0.0)), item(b, b["size"])
        a_more, b_less = item(a, a["mass"] + b["mass"]), item(b, b["mass"] - (a["size"] - a["mass"]))
        b_more, a_less = item(b, b["mass"] + a["mass"]), item(a, a["mass"] - (b["size"] - b["mass"]))
        fills_a, empties_a = a["size"] - a["mass"] <= b["mass"], a["mass"] <= b["size"] - b["mass"]
        carry = F.when(rises, F.when(fills_a, b_less).otherwise(a_more)).otherwise(F.when(empties_a, b_more).otherwise(a_less))
        done = F.when(rises, F.when(fills_a, a_full).otherwise(b_empty)).otherwise(F.when(empties_a, a_empty).otherwise(b_full))
        return F.struct(carry.alias("carry"), F.concat(acc["done"], F.array(done)).alias("done"))

    first = F.struct(F.element_at("open", 1).alias("carry"), F.slice("open", 1, 0).alias("done"))
    return F.aggregate(F.slice("open", 2, F.greatest(F.size("open") - 1, F.lit(0))), first, step)


def rounded(open_rows: DataFrame, group: str = "source", label: str = "mix") -> DataFrame:
    """Rounds the masses of rows (group, id, salt, size, mass), 0 <= mass <= size, to 0 or size.

    Each group keeps its sum to within one size; each row keeps its mass in expectation. A level of
    the tree deals the rows that are left to nodes of about FAN_IN rows by hash and folds each; the
    next level gets one row per node. At the root the last row is drawn by its own mass. Nodes are
    small whatever the group, and levels are as many as the logarithm of the largest group.
    """
    counts = open_rows.groupBy(group).agg(F.count("*").alias("n"))
    levels, largest = 1, counts.agg(F.max("n")).first()[0] or 0
    while largest > FAN_IN**levels:
        levels += 1
    left = open_rows.join(counts, open_rows[group].eqNullSafe(counts[group]), "left").drop(counts[group])
    left = left.withColumn("nodes", F.ceil(F.col("n") / FAN_IN)).drop("n")
    decided = []
    for level in range(levels):
        node = F.pmod(F.xxhash64(F.lit(level), "id", "salt"), F.col("nodes"))
        items = F.sort_array(F.collect_list(F.struct("id", "salt", F.col("size").cast("double").alias("size"), F.col("mass").cast("double").alias("mass"))))
        folded = left.groupBy(group, "nodes", node.alias("node")).agg(items.alias("open")).withColumn("end", _fold(level)).drop("open")
        folded = materialise(folded, f"{label}-level{level}")
        decided.append(folded.select(group, F.explode("end.done").alias("x")).select(group, "x.id", "x.salt", (F.col("x.mass") > 0).alias("takes")))
        left = folded.select(group, F.ceil(F.col("nodes") / FAN_IN).alias("nodes"), "end.carry.*")
    root = unit_draw(F.lit(-1), F.col("id"), F.col("salt")) * F.col("size") < F.col("mass")
    decided.append(left.select(group, "id", "salt", root.alias("takes")))
    whole = decided[0]
    for part in decided[1:]:
        whole = whole.union(part)
    return whole


def mixed(
    docs: DataFrame,
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    most: float = 2.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per document: id, key, size, source, source_size, target, copies, taken.

    ``size`` counts runs of characters other than white space (a null text has none). Every document of
    a source has the same expected copies, target / source_size; the whole part is certain, the rest is
    rounded by pivots, in units of words, so that the words taken of a source stay within one document
    of its target and no document is taken more than ``most`` times, rounded up. The draws depend on
    the id, text and source of a row alone, so a rerun agrees however the input is split; rows that are equal in
    these (null ids included) are numbered, and any of them may be the one that is taken. ``key`` hashes the text. Other columns are ignored, whatever their names. Sources
    without words have target 0, and an empty table gives an empty result.
    """
    text = named(text_col).cast("string")
    rows = docs.select(
        named(id_col).alias("id"),
        text_key(text).alias("key"),
        named(source_col).cast("string").alias("source"),
        word_count(text).alias("size"),
    )
    rows = materialise(with_copies_numbered(rows), "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = materialise(source_targets(sizes, weights, share, most), "mix-sources")
    targets = targets.select(F.col("source").alias("_source"), "source_size", "target")
    share_of = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    planned = rows.join(targets, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    planned = planned.withColumn("_sure", F.floor(share_of)).withColumn("_mass", (share_of - F.floor(share_of)) * F.col("size"))
    open_rows = planned.where("_mass > 0").select("source", "id", "salt", "size", F.col("_mass").alias("mass"))
    drawn = rounded(open_rows).select(F.col("id").alias("_id"), F.col("salt").alias("_salt"), "takes")
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("salt") == F.col("_salt"))
    joined = planned.join(drawn, same, "left")
    copies = (F.col("_sure") + F.coalesce(F.col("takes").cast("long"), F.lit(0))).cast("long")
    return joined.select("id", "key", "size", "source", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``docs`` with all its columns, each row as often as :func:`mixed` takes it.

    Rows that share id and text are one row with the copies of all of them.
    """
    plan = mixed(docs, id_col=id_col, text_col=text_col, **settings)
    plan = materialise(plan.groupBy("id", "key").agg(F.sum("copies").alias("copies"), F.count("*").alias("n")), "mix-plan")
    plan = plan.where("copies > 0").select(F.col("id").alias("_id"), F.col("key").alias("_key"), "copies", "n")
    packed = docs.select(F.struct("*").alias("row"), named(id_col).alias("id"), text_key(named(text_col).cast("string")).alias("key"))
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key"))
    taken = packed.join(plan.where("n = 1"), same).select("row", "copies")
    repeated = plan.where("n > 1")
    if not repeated.isEmpty():
        # left out where it is empty, since the join would shuffle every text once more before Spark sees that
        taken = taken.union(packed.join(repeated, same).dropDuplicates(["id", "key"]).select("row", "copies"))
    # in blocks of a thousand, since rows that share id and text may have any number of copies
    blocks = taken.withColumn("_block", F.explode(F.sequence(F.lit(1), F.ceil(F.col("copies") / 1000))))
    some = F.least(F.lit(1000), F.col("copies") - (F.col("_block") - 1) * 1000)
    return blocks.withColumn("_copy", F.explode(F.sequence(F.lit(1), some.cast("int")))).select("row.*")
