"""Connected components, by stars that are drawn towards their least node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import cut


def components(edges: DataFrame, keys: list[str]) -> DataFrame:
    """keys, a, b (longs, of links inside a key) -> keys, node, root: the least node that
    can be reached, for every node that has a link.

    Each node's greater neighbours are linked to the least of its neighbours and itself,
    then its smaller ones; by and by every node is linked to its root alone. The number
    of rounds grows with the logarithm of the longest chain."""
    pairs = edges.filter("a <> b").select(*keys, F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    links, last = cut(pairs), None
    while True:
        both = links.select(*keys, F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(links.select(*keys, F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy(*keys, "u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, [*keys, "u"]).filter("v > u").select(*keys, F.col("v").alias("hi"), F.col("m").alias("lo"))
        large = cut(large.filter("hi <> lo").distinct())
        lows = large.groupBy(*keys, "hi").agg(F.min("lo").alias("m"))
        small = large.join(lows, [*keys, "hi"]).filter("lo <> m").select(*keys, F.col("lo").alias("hi"), F.col("m").alias("lo"))
        links = cut(small.unionByName(lows.select(*keys, "hi", F.col("m").alias("lo"))).distinct())
        state = links.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64(*keys, "hi", "lo")).alias("x")).first()
        if state == last:
            break
        last = state
    roots = links.select(*keys, F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    return links.select(*keys, F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(roots)
