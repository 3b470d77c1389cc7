"""Small pieces that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from matchday.workspace import materialise

#: The white space that counts as such in every operator: space and U+0009 to U+000D.
WHITE_SPACE = r"\x20\x09-\x0D"

#: Rows (two numbers and a short key) up to which the rows that leave a table are sent to all tasks, which then need not
#: shuffle the texts; about 40 MB. Beyond, both sides are shuffled.
MOST_BROADCAST = 400_000

#: Rows of an Arrow batch that carries texts.
TEXTS_PER_BATCH = 500


def named(name: str) -> Column:
    """The column called exactly ``name``, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def in_small_batches(rows: DataFrame) -> DataFrame:
    """``rows`` as they are, after the session was told to hand Python no more than TEXTS_PER_BATCH rows at a time.

    A row is a text here, and may be long; Spark's default of 10,000 rows would fill a task's memory twice,
    in the executor and in its worker. A smaller setting of the session stays.
    """
    conf, name = rows.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= TEXTS_PER_BATCH:
        conf.set(name, str(TEXTS_PER_BATCH))
    return rows


def with_fields(rows: DataFrame, more: str) -> str:
    """The schema of ``rows`` and ``more`` fields, as a declaration."""
    return ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields], more])


def text_key(text: Column) -> Column:
    """Together with the id, what tells one row from another: equal only for null or equal texts."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def unit_draw(*key: Column) -> Column:
    """A number in (0, 1) that depends on nothing but ``key``."""
    return (F.shiftrightunsigned(F.xxhash64(*key), 11).cast("double") + 0.5) / F.lit(float(2**53))


def with_salt(rows: DataFrame, key: str = "id", salt: str = "salt") -> DataFrame:
    """Adds ``salt``: 0 where ``key`` occurs once, else a number that differs from row to row.

    (key, salt) then names a row, so a key that holds a third of all rows still spreads over all tasks.
    The result has to be written before it is used twice, since the numbers follow the partitions.
    """
    repeated = rows.groupBy(F.col(key).alias("_again")).count().where("count > 1").select("_again", F.lit(True).alias("_is_again"))
    joined = rows.join(repeated, rows[key].eqNullSafe(repeated["_again"]), "left")
    number = F.monotonically_increasing_id() + 1
    return joined.withColumn(salt, F.when(F.col("_is_again"), number).otherwise(F.lit(0))).drop("_again", "_is_again")


def with_copies_numbered(rows: DataFrame, salt: str = "salt", at_once: int = 1000) -> DataFrame:
    """``rows`` plus ``salt``: a hash of all columns and of the number of a row among those equal to it.

    Equal rows are counted and made again, so the numbers do not depend on where a row stood. Many copies of a row
    are made in blocks that are dealt out first, so no task makes them all.
    """
    counted = materialise(rows.groupBy(*rows.columns).agg(F.count("*").alias("_n")), "counted-rows")
    counted = counted.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / at_once))))
    many = counted.where(F.col("_n") > at_once).repartition(*rows.columns, "_block")
    blocks = counted.where(F.col("_n") <= at_once).union(many)
    first = F.col("_block") * at_once
    numbers = F.sequence(first + 1, F.least(first + at_once, F.col("_n")))
    made = blocks.withColumn("_number", F.explode(numbers))
    return made.withColumn(salt, F.xxhash64(*rows.columns, "_number")).select(*rows.columns, salt)


def components(nodes_and_links: DataFrame, label: str) -> DataFrame:
    """(node, component): the smallest node reachable over links (a, b), for every node that has one.

    Alternates large-star and small-star steps: each replaces links by links to a smaller neighbour, so
    the number of links never grows and the depth of the stars shrinks logarithmically. Between steps
    the links are written to the shared folder. Neighbours are reduced with ``min`` before they move;
    no neighbourhood is gathered, whatever the degree.
    """
    links = nodes_and_links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    links = materialise(links, label)
    while True:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # written, so that Spark can split the rows of a node with many neighbours when it joins
        least = materialise(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), f"{label}-least")
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a != b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        down = materialise(down, f"{label}-large")
        lowest = materialise(down.groupBy("a").agg(F.min("b").alias("m")), f"{label}-lowest")
        joined = down.join(lowest, "a")
        small = joined.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(lowest.select("a", F.col("m").alias("b"))).where("a != b").distinct()
        stepped = materialise(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), label)
        if stepped.exceptAll(links).isEmpty() and links.exceptAll(stepped).isEmpty():
            return stepped.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                stepped.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        links = stepped


def held_out(id_col: Column) -> Column:
    """The quarter of ids that no model learns from; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def sampled(rows: DataFrame, label: str, per_label: int, *key: str, most: int | None = None) -> DataFrame:
    """About ``per_label`` rows of every non-null label (all, if it has fewer), drawn by a hash of ``key``.

    For the training of models, which see a bounded number of rows whatever the table. ``most`` bounds the rows of
    all labels together (a thousand times ``per_label`` if it is not given): with more labels than that allows,
    each gives its even part of it, be it less than a row.
    """
    rows = rows.where(F.col(label).isNotNull())
    counts = materialise(rows.groupBy(F.col(label).alias("_label")).agg(F.count("*").alias("_n")), "sample-labels")
    each = min(float(per_label), (most or 1000 * per_label) / max(1, counts.count()))
    joined = rows.join(counts, F.col(label) == F.col("_label"))
    drawn = unit_draw(*[F.col(k) for k in key], F.lit("sample")) < F.lit(each) / F.col("_n")
    return joined.where(drawn).drop("_label", "_n")


def leave_one(docs: DataFrame, acts: DataFrame, group: str, id_col: str, text_col: str) -> DataFrame:
    """``docs`` without the rows whose act (group, id, key, stays, n) says so, and one of those of a group that tie."""
    ties = acts.where("stays").groupBy(group).agg(F.sum("n").alias("ties")).where("ties > 1").select(group, F.lit(True).alias("_tied"))
    marked = acts.join(ties, group, "left").where("not stays or _tied")
    marked = materialise(marked.select(F.col("id").alias("_id"), F.col("key").alias("_key"), F.col(group).alias("_group"), "stays"), "leave-one")
    tied = marked.where("stays")
    repeats = not tied.isEmpty()
    if marked.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST:
        marked, tied = F.broadcast(marked), F.broadcast(tied)
    packed = docs.select(F.struct("*").alias("row"), named(id_col).alias("id"), text_key(named(text_col).cast("string")).alias("key"))
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key"))
    untouched = packed.join(marked, same, "left_anti").select("row.*")
    if not repeats:
        # the join with no rows would shuffle every text once more before Spark sees that it is empty
        return untouched
    return untouched.unionByName(packed.join(tied, same).dropDuplicates(["_group"]).select("row.*"))
