from __future__ import annotations

import re
from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from matchday.llm.pivotal import FAN_IN, mix, mixed, rounded, source_targets


def shared_out(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """By the wording: share by weight, stop at the cap, share the excess again."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = dict.fromkeys(names, 0.0), set(names), share * sum(sizes.values())
    while open_ and left > 1e-9:
        rate = left / sum(weight[s] for s in open_)
        left = 0.0
        for s in open_:
            target[s] += rate * weight[s]
        for s in [s for s in open_ if target[s] >= most * sizes[s]]:
            left += target[s] - most * sizes[s]
            target[s] = most * sizes[s]
            open_.discard(s)
    return target


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 1, "c": 1}, {"é": 10, "a": 500, None: 30, "z": 0, "b": 70}, {"a": 0}, {"a": 5}])
def test_targets(spark, sizes):
    frame = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, source_size long")
    found = {r.source: r.target for r in source_targets(frame, (5.0, 2.0, 1.0), 1.5, 2.0).collect()}
    assert found == pytest.approx(shared_out(sizes), abs=1e-6)


def test_mix_meets_targets(spark, documents):
    found = mixed(spark.createDataFrame(documents).repartition(5, "doc_id")).collect()
    words = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in zip(documents.doc_id, documents.text, strict=True)}
    assert {r.id: r.size for r in found} == words
    taken, largest, target = defaultdict(int), defaultdict(int), {}
    for r in found:
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
        target[r.source] = r.target
        assert r.taken in (0, r.size, 2 * r.size)
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in taken)
    again = mixed(spark.createDataFrame(documents).repartition(3, "source")).collect()
    assert {(r.id, r.taken) for r in again} == {(r.id, r.taken) for r in found}


def test_rounding_keeps_sums_and_expectation(spark):
    rows = spark.range(3000).select(F.lit("s").alias("source"), "id", F.lit(0).cast("long").alias("salt"), (F.col("id") % 7 + 1).alias("size"))
    rows = rows.withColumn("mass", F.col("size") * 0.3)
    found = rounded(rows).join(rows.select("id", "size"), "id").collect()
    assert len(found) == 3000
    assert abs(sum(r.size for r in found if r.takes) - 0.3 * sum(r.size for r in found)) <= 7
    for size in range(1, 8):
        same = [r.takes for r in found if r.size == size]
        assert abs(sum(same) / len(same) - 0.3) < 0.09


def hashed(level, *longs):
    value = xxhash.xxh64_intdigest(level.to_bytes(4, "little", signed=True), 42)
    for x in longs:
        value = xxhash.xxh64_intdigest(x.to_bytes(8, "little", signed=True), value)
    return value


def unit(level, *longs):
    return ((hashed(level, *longs) >> 11) + 0.5) / 2**53


def folded_by_hand(rows):
    """Which rows (id, salt, size, mass) of one group the tree of pivots takes, a pair at a time."""
    takes, left, nodes, levels = {}, rows, -(-len(rows) // FAN_IN), 1
    while len(rows) > FAN_IN**levels:
        levels += 1
    for level in range(levels):
        dealt = defaultdict(list)
        for r in left:
            value = hashed(level, r[0], r[1])
            dealt[(value - 2**64 if value >= 2**63 else value) % nodes].append(r)
        left, nodes = [], -(-nodes // FAN_IN)
        for items in dealt.values():
            items.sort()
            carry = items[0]
            for other in items[1:]:
                (i, s, size, mass), (j, t, wide, much) = carry, other
                up, down = min(size - mass, much), min(mass, wide - much)
                if unit(level, j, t, i, s) * (up + down) < down:
                    mass, much = mass + up, much - up
                    finished = (i, s, True) if size - carry[3] <= other[3] else (j, t, False)
                else:
                    mass, much = mass - down, much + down
                    finished = (i, s, False) if carry[3] <= wide - other[3] else (j, t, True)
                takes[finished[:2]] = finished[2]
                carry = (j, t, wide, much) if finished[:2] == (i, s) else (i, s, size, mass)
            left.append(carry)
    for i, s, size, mass in left:
        takes[i, s] = unit(-1, i, s) * size < mass
    return takes


def test_rounding_equals_a_fold_by_hand(spark):
    # masses are eighths, so that sums are exact
    rows = [(i // 2, 5 * (i % 2), float(i % 9 + 1), (i % 9 + 1) * ((i * 5) % 7 + 1) / 8) for i in range(2500)]
    for some in (rows, rows[:1], rows[:32], rows[:33]):
        frame = spark.createDataFrame([("s", *r) for r in some], "source string, id long, salt long, size double, mass double")
        assert {(r.id, r.salt): r.takes for r in rounded(frame).collect()} == folded_by_hand(some)


def test_odd_rows(odd, empty):
    found = mixed(odd).collect()
    assert len(found) == odd.count()
    assert mixed(empty).count() == 0 and mix(empty).count() == 0
    rows = mix(odd)
    assert rows.columns == odd.columns
    assert rows.count() == sum(r.copies for r in found)


def test_no_python(spark, documents):
    plan = mixed(spark.createDataFrame(documents))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_reruns_agree_however_the_input_is_split(spark):
    rows = [(i // 2 if i % 3 else None, f"{'word ' * (i % 17)}{i % 5}", "ab"[i % 2]) for i in range(900)] + [(7, "again and again", "a")] * 2500
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = [sorted(((r.id, r.key, r.source, r.taken) for r in mixed(frame.repartition(n)).collect()), key=repr) for n in (1, 7)]
    assert found[0] == found[1] and len(found[0]) == len(rows)
    words = sum(len(t.split()) for _, t, _ in rows)
    assert abs(sum(r[3] for r in found[0]) - 1.5 * words) <= 2 * 17
