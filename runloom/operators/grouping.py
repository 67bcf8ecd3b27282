"""Greedy grouping of similar barcodes.

The most frequent barcode left becomes a reference and takes in every barcode left
that matches it; and so on. That is the first maximal independent set, in rank
order, of the graph of matches, and each other barcode goes to its earliest
adjacent reference. Two ways give it: a grouped function over the few barcodes of
a lane that pass the weeding cut-off, and, for any number, joins that find the
matches, whose connected components don't touch each other: a task decides those of
its own in rank order, and only one too large for a task is decided in rounds of joins. Lanes,
a missing one too, and all lanes together (`barcodes.scoped`) are grouped alike.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import barcodes as B
from ..sources.shared import checked_broadcast, cut
from . import barcodes as C
from .graphs import components

#: Barcodes of a lane that one task groups, by comparing each reference with all that are left.
LANE_ROWS = 20_000
#: Barcodes of a component that one task decides, and of all components that it gets.
COMPONENT_ROWS, TASK_ROWS = 200_000, 50_000


def in_rank_order(found: DataFrame, seeds: DataFrame | None = None) -> DataFrame:
    """Rank in the lane: seeds first, in the order given (`seed_order`; without it by
    barcode), then the others by count, ties by barcode. Seeds are few; the others
    are ranked without a window over the lane."""
    keys = C.keys_of(found)
    if seeds is None:
        return C.ranked(found).select(*keys, "barcode", "n", "rank")
    order = F.col("seed_order") if "seed_order" in seeds.columns else F.col("index_seq")
    marks = C.sheet_of(found, seeds).groupBy(*keys, F.col("index_seq").alias("barcode")).agg(F.min(order).alias("_order"))
    marked = C.meet(found, checked_broadcast(marks), [*keys, "barcode"], "left")
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("_order", "barcode")).cast("long")
    first = cut(marked.filter("_order IS NOT NULL").withColumn("rank", place).select(*keys, "barcode", "n", "rank"))
    ahead = checked_broadcast(first.groupBy(*keys).agg(F.count("*").alias("_ahead")))
    others = C.meet(C.ranked(marked.filter("_order IS NULL").drop("_order")), ahead, keys, "left")
    return first.unionByName(others.select(*keys, "barcode", "n", (F.col("rank") + F.coalesce("_ahead", F.lit(0))).alias("rank")))


def weeded(found: DataFrame, fraction: float) -> DataFrame:
    return C.above(found, fraction).drop("lane_total")


def group_in_lanes(ranked: DataFrame, mismatches: int) -> DataFrame:
    """lane, barcode, n, reference, by a grouped function: for lanes of few barcodes."""
    keys = C.keys_of(ranked)
    schema = ranked.select(*keys, "barcode", "n", F.col("barcode").alias("reference")).schema

    def greedy(lane: pd.DataFrame) -> pd.DataFrame:
        lane = lane.sort_values("rank", ignore_index=True)
        shape = lane["barcode"].map(lambda x: tuple(map(len, x.split("+"))))
        reference = np.full(len(lane), -1)
        for sizes in shape.unique():
            at = np.flatnonzero(shape.map(lambda x: x == sizes).to_numpy())
            letters = np.array([list(b.replace("+", "").encode()) for b in lane["barcode"].iloc[at]], np.uint8).reshape(len(at), -1)
            borders, known = np.cumsum((0, *sizes)), letters != ord("N")
            left = np.arange(len(at))
            while len(left):
                k, rest = left[0], left[1:]
                apart = (letters[rest] != letters[k]) | ~known[rest] | ~known[k]
                near = np.ones(len(rest), bool)
                for a, b in zip(borders, borders[1:], strict=False):
                    near &= apart[:, a:b].sum(1) <= mismatches
                reference[at[k]] = at[k]
                reference[at[rest[near]]] = at[k]
                left = rest[~near]
        return lane.assign(reference=lane["barcode"].to_numpy()[reference])[[*keys, "barcode", "n", "reference"]]

    return ranked.groupBy(*keys).applyInPandas(greedy, schema)


def matching_pairs(ranked: DataFrame, mismatches: int) -> DataFrame:
    """key, early, late (ranks): all matching pairs. Each index is cut into
    mismatches + 1 pieces; matching barcodes share a piece of every index, so only
    those meet."""
    n = mismatches + 1
    split = F.split("barcode", r"\+")
    part = lambda i: F.coalesce(F.get(split, F.lit(i)), F.lit(""))
    shape = F.array_join(F.transform(split, lambda x: F.length(x).cast("string")), "+")
    rows = ranked.select("key", "barcode", "rank", shape.alias("shape"), F.inline(B.pieces(part(0), n)))
    second = F.when(F.size(split) > 1, B.pieces(part(1), n)).otherwise(F.array(F.struct(F.lit(0).alias("k"), F.lit("").alias("piece"))))
    rows = rows.select("key", "barcode", "rank", "shape", F.col("k").alias("k1"), F.col("piece").alias("piece1"), F.inline(second))
    a, b = rows.alias("a"), rows.alias("b")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("key", "shape", "k1", "piece1", "k", "piece")]
    pairs = a.join(b, [*same, F.col("a.rank") < F.col("b.rank")]).filter(B.matches(F.col("b.barcode"), F.col("a.barcode"), mismatches))
    return pairs.select(F.col("a.key").alias("key"), F.col("a.rank").alias("early"), F.col("b.rank").alias("late")).distinct()


def decided_in_rounds(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """key, rank; key, early, late -> key, rank, r (the rank of its reference), by joins.
    In a round, a barcode without earlier undecided neighbours is decided: member if an
    earlier neighbour is a reference, else a reference itself."""
    state = nodes.select("key", F.col("rank").alias("late"), F.lit(None).cast("boolean").alias("is_reference"))
    while True:
        early = state.select("key", F.col("late").alias("early"), F.col("is_reference").alias("of_early"))
        seen = edges.join(early, ["key", "early"]).groupBy("key", "late").agg(
            F.max(F.col("of_early").isNull()).alias("waits"), F.max(F.coalesce("of_early", F.lit(False))).alias("taken")
        )
        told = F.when(F.col("taken"), F.lit(False)).when(~F.coalesce("waits", F.lit(False)), F.lit(True))
        state = cut(state.join(seen, ["key", "late"], "left").select("key", "late", F.coalesce("is_reference", told).alias("is_reference")))
        if state.filter("is_reference IS NULL").isEmpty():
            break
    references = state.filter("is_reference").select("key", F.col("late").alias("early"))
    own = edges.join(references, ["key", "early"]).groupBy("key", "late").agg(F.min("early").alias("r"))
    return state.join(own, ["key", "late"], "left").select("key", F.col("late").alias("rank"), F.when(F.col("is_reference"), F.col("late")).otherwise(F.col("r")).alias("r"))


def decided_in_tasks(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """The same for components (key, root, rank) that a task can hold, several to a task:
    in rank order, a barcode goes to its earliest neighbour that is a reference, or is
    one."""

    def decide(batch: pd.DataFrame) -> pd.DataFrame:
        batch, reference, out = batch.sort_values("rank", ignore_index=True), set(), []
        for key, rank, earlier in zip(batch["key"], batch["rank"], batch["earlier"], strict=True):
            near = [e for e in (earlier if earlier is not None else ()) if (key, e) in reference]
            if not near:
                reference.add((key, rank))
            out.append(min(near, default=rank))
        return batch.assign(r=out)[["key", "rank", "r"]]

    earlier = edges.groupBy("key", F.col("late").alias("rank")).agg(F.collect_list("early").alias("earlier"))
    tasks = max(1, -(-nodes.count() // TASK_ROWS))
    rows = nodes.join(earlier, ["key", "rank"], "left").withColumn("task", F.pmod(F.xxhash64("key", "root"), F.lit(tasks)))
    return rows.groupBy("task").applyInPandas(decide, "key string, rank long, r long")


def group_by_matches(ranked: DataFrame, mismatches: int, rows: int = COMPONENT_ROWS) -> DataFrame:
    """lane, barcode, n, reference for any number of barcodes, from their matches. `rows`
    is the size of a component beyond which it is decided in rounds."""
    keys = C.keys_of(ranked)
    # One column that is never null stands for scope and lane.
    ranked = cut(ranked.withColumn("key", F.to_json(F.struct(*keys))))
    edges = cut(matching_pairs(ranked, mismatches))
    linked = cut(components(edges.select("key", F.col("early").alias("a"), F.col("late").alias("b")), ["key"]).withColumnRenamed("node", "rank"))
    large = cut(linked.groupBy("key", "root").count().filter(F.col("count") > rows).select("key", "root"))
    placed = decided_in_tasks(linked.join(large, ["key", "root"], "left_anti"), edges)
    if not large.isEmpty():
        nodes = cut(linked.join(large, ["key", "root"], "left_semi"))
        inside = edges.join(nodes.select("key", F.col("rank").alias("late")), ["key", "late"], "left_semi")
        placed = placed.unionByName(decided_in_rounds(nodes, cut(inside)))
    # What matches nothing is a group of its own.
    found = ranked.join(placed, ["key", "rank"], "left").withColumn("r", F.coalesce("r", "rank"))
    names = ranked.select("key", F.col("rank").alias("r"), F.col("barcode").alias("reference"))
    return found.join(names, ["key", "r"]).select(*keys, "barcode", "n", "reference")


def grouped(
    found: DataFrame, mismatches: int = 2, cutoff: float | None = None, seeds: DataFrame | None = None, fraction: float = 1e-6, by_matches: bool | None = None, all_lanes: bool = False
) -> DataFrame:
    """lane, reference, n_sequences, n of each group. Groups below the cut-off are
    dropped after they have taken in their members. Lanes are grouped by a function
    where the largest keeps `LANE_ROWS` barcodes at most, by their matches beyond;
    `by_matches` says so beforehand. The groups are the same. With `all_lanes` barcodes
    are also grouped over all lanes, in the same pass."""
    found = cut(C.scoped(found) if all_lanes else found)
    keys = C.keys_of(found)
    kept = in_rank_order(weeded(found, fraction), seeds)
    if by_matches is None:
        by_matches = (weeded(found, fraction).groupBy(*keys).count().agg(F.max("count")).first()[0] or 0) > LANE_ROWS
    members = (group_by_matches if by_matches else group_in_lanes)(kept, mismatches)
    groups = members.groupBy(*keys, "reference").agg(F.count("*").alias("n_sequences"), F.sum("n").alias("n"))
    if cutoff is not None:
        totals = checked_broadcast(found.groupBy(*keys).agg(F.sum("n").alias("_t")))
        groups = C.meet(groups, totals, keys).filter(F.col("n") >= F.floor(F.col("_t") * cutoff)).drop("_t")
    return groups
