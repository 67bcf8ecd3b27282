"""Pivotal rounding against a plain loop and its expectations; copies of a hot row."""

import collections
import random
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from runloom.llm import mixing

ITEMS = "group string, rid long, rid2 long, size long, p double"


def hashed(*values):
    """Spark's xxhash64 of ints (marked by a tuple) and longs, as a signed number."""
    seed = 42
    for v in values:
        seed = xxhash.xxh64(struct.pack("<i", v[0]) if isinstance(v, tuple) else struct.pack("<q", v), seed).intdigest()
    return seed - (1 << 64) if seed >> 63 else seed


def number(*values):
    return hashed(*values) % (1 << 53) / float(1 << 53)


def plainly(items, fan_in):
    """(rid, rid2) -> up: pairs meet one after the other, block by block and level by level."""
    ups, level = {}, 0
    largest = max(collections.Counter(x[0] for x in items).values())
    while True:
        blocks, dealt, rests = -(-largest // fan_in), collections.defaultdict(list), []
        for group, rid, rid2, size, p in items:
            dealt[group, 0 if largest <= fan_in else hashed(rid, rid2, (level,)) % blocks].append((size, rid, rid2, p))
        for (group, _), block in dealt.items():
            a, *others = sorted(block, reverse=True)
            for b in others:
                up_a, down_a, up_b, down_b = (1 - a[3]) * a[0], a[3] * a[0], (1 - b[3]) * b[0], b[3] * b[0]
                gain, loss = min(up_a, down_b), min(down_a, up_b)
                if number((level,), a[1], a[2], b[1], b[2]) * (gain + loss) < loss:  # a rises
                    if up_a <= down_b:
                        ups[a[1:3]], a = 1, (*b[:3], b[3] - up_a / b[0])
                    else:
                        ups[b[1:3]], a = 0, (*a[:3], a[3] + down_b / a[0])
                elif down_a <= up_b:
                    ups[a[1:3]], a = 0, (*b[:3], b[3] + down_a / b[0])
                else:
                    ups[b[1:3]], a = 1, (*a[:3], a[3] - up_b / a[0])
            rests.append((group, a[1], a[2], a[0], a[3]))
        items = rests
        if largest <= fan_in:
            return ups | {(rid, rid2): int(number((-1,), rid, rid2) < p) for _, rid, rid2, _, p in items}
        largest, level = blocks, level + 1


@pytest.mark.parametrize("fan_in", [3, 16, 1000])
def test_rounding_is_that_of_a_plain_loop(spark, fan_in):
    dice = random.Random(fan_in)
    wide = lambda: dice.getrandbits(64) - (1 << 63)
    items = [(g, wide(), wide(), dice.choice((1, 7, 50, dice.randint(1, 5000))), dice.random()) for g, n in (("a", 400), ("b", 40), ("c", 1)) for _ in range(n)]
    got = mixing.round_dependently(spark.createDataFrame(items, ITEMS), fan_in).collect()
    assert len(got) == len(items)
    assert {(r.rid, r.rid2): r.up for r in got} == plainly(items, fan_in)
    for group in "abc":
        mine = [x for x in items if x[0] == group]
        ups = {(r.rid, r.rid2): r.up for r in got}
        assert abs(sum((ups[x[1:3]] - x[4]) * x[3] for x in mine)) < max(x[3] for x in mine)


def test_each_item_is_rounded_up_as_often_as_its_share(spark):
    shapes, dice, trials = [(5, 0.3), (9, 0.5), (40, 0.9), (40, 0.05), (100, 0.25)], random.Random(1), 3000
    items = [(str(t), k, dice.getrandbits(62), size, p) for t in range(trials) for k, (size, p) in enumerate(shapes)]
    shares = mixing.round_dependently(spark.createDataFrame(items, ITEMS), 3).groupBy("rid").agg(F.avg("up").alias("mean")).collect()
    for r in shares:
        p = shapes[r.rid][1]
        assert abs(r["mean"] - p) < 4.5 * (p * (1 - p) / trials) ** 0.5, (r, p)


@pytest.mark.parametrize("sent", [True, False])
def test_copies_of_a_hot_row_are_numbered_in_their_partitions(spark, monkeypatch, sent):
    """Nine rows in ten are the same; beyond the bound of a broadcast, too, they are
    numbered where they are, and the numbers have no gaps."""
    if not sent:
        monkeypatch.setattr(mixing, "checked_broadcast", lambda df, rows=0: df)
        monkeypatch.setattr(mixing.F, "broadcast", lambda df: df)
    rows = spark.range(4000).repartition(16).select(
        F.when(F.col("id") % 10 == 0, F.col("id") % 900).otherwise(F.lit(-1)).cast("long").alias("_rid"), F.lit(5).cast("long").alias("_rid2"), F.lit("x").alias("kept"),
        F.spark_partition_id().alias("_part"),
    )
    rows = rows.checkpoint()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit if sent else "-1")
    try:
        made = mixing.numbered(rows)
        plan = made._jdf.queryExecution().toString()
        got = [tuple(r) for r in made.select("_rid", "_rid2", "kept").collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert ("BroadcastHashJoin" in plan) == sent and made.columns == ["_rid", "_rid2", "kept"]
    assert len(got) == len(set(got)) == 4000
    # Each copy's second number is the hash of its place, from 1 on.
    for rid, n in collections.Counter(x[0] for x in got).items():
        seconds = {x[1] for x in got if x[0] == rid}
        assert seconds == ({5} if n == 1 else {hashed(5, k) for k in range(1, n + 1)})
    largest = rows.groupBy("_rid", "_part").count().agg(F.max("count")).first()[0]
    assert largest < 400  # what a task numbers, of 3,600 copies
