"""Mixing sources to target weights by pivotal dependent rounding.

A source's target is its weighted share of the mix, at most `cap` times its own
size; the excess goes to the other sources by weight. Each document of a source
then has the same expected number of copies, target / size. The whole part is
taken as it is; the fractions are rounded dependently: two documents meet, and
mass (probability times size) moves at random from one to the other until one
of them is integral, so that expectations and the source's total stay as they
were. A block folds its documents into one fractional rest; the rests meet in
the next level of a tree, until one is left for each source. So the words taken
from a source differ from its target by less than its largest document.

A source with a third of all rows is spread over as many blocks as any other
rows; no block has more than about `fan_in` rows.

Defined results: null and empty texts have size 0 and are taken 0 times over 0
words; a null source is a source of its own, the last; repeated rows count as
documents of their own; sources of size 0 have target 0; an empty table gives an
empty result. Very long texts are counted whole; other columns may have any
names. Random numbers and blocks come from hashes of the rows' content, so reruns
agree, however the rows are dealt over partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checked_broadcast, cut, quoted, shared_folder, text_of, unit, words_of

#: Items are folded from the largest down, so that the rest is a small one.
ITEM = "struct<size:bigint,rid:bigint,rid2:bigint,p:double>"
OUT = "array<struct<rid:bigint,rid2:bigint,up:int>>"


def targets(by_source: DataFrame, weights=(3, 1, 2), ratio: float = 1.5, cap: float = 2.0) -> DataFrame:
    """source, source_size -> also target. One row for each source.

    The weights repeat along the sources in order of code points, null last. A
    common level is filled: target = least(cap * size, level * weight). The
    source table has a row for each source, so its global windows are small."""
    order = Window.orderBy(F.asc_nulls_last("source"))
    weight = F.get(F.array(*[F.lit(float(x)) for x in weights]), F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))))
    sized = by_source.withColumn("_w", weight).withColumn("_c", F.lit(cap) * F.col("source_size"))
    rising = Window.orderBy(F.col("_c") / F.col("_w"), F.asc_nulls_last("source"))
    before, everything = rising.rowsBetween(Window.unboundedPreceding, -1), Window.rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    # The level if all sources before this one stay at their caps; the largest of them is the one that holds.
    left = F.lit(ratio) * F.sum("source_size").over(everything.orderBy(F.lit(1))) - F.coalesce(F.sum("_c").over(before), F.lit(0.0))
    open_weight = F.sum("_w").over(rising.rowsBetween(0, Window.unboundedFollowing))
    levels = sized.withColumn("_level", left / open_weight)
    level = F.max("_level").over(everything.orderBy(F.lit(1)))
    return levels.select("source", "source_size", F.least(F.col("_c"), level * F.col("_w")).alias("target"))


def _fold(items: Column, level: int) -> Column:
    """One struct for a block: `rest`, an item or null, and `out`, the rounded."""
    start = F.struct(F.lit(None).cast(ITEM).alias("rest"), F.array().cast(OUT).alias("out"))

    def meet(state, b):
        a = state["rest"]
        up_a, down_b = (1 - a["p"]) * a["size"], b["p"] * b["size"]
        down_a, up_b = a["p"] * a["size"], (1 - b["p"]) * b["size"]
        gain, loss = F.least(up_a, down_b), F.least(down_a, up_b)
        rises = unit(F.lit(level), a["rid"], a["rid2"], b["rid"], b["rid2"]) * (gain + loss) < loss
        item = lambda x, p: F.struct(x["size"].alias("size"), x["rid"].alias("rid"), x["rid2"].alias("rid2"), p.alias("p"))
        done = lambda x, up: F.struct(x["rid"].alias("rid"), x["rid2"].alias("rid2"), F.lit(up).alias("up"))
        then = lambda rest, out: F.struct(rest.alias("rest"), F.concat(state["out"], F.array(out)).alias("out"))
        return (
            F.when(a.isNull(), F.struct(b.cast(ITEM).alias("rest"), state["out"].alias("out")))
            .when(rises & (up_a <= down_b), then(item(b, b["p"] - up_a / b["size"]), done(a, 1)))
            .when(rises, then(item(a, a["p"] + down_b / a["size"]), done(b, 0)))
            .when(down_a <= up_b, then(item(b, b["p"] + down_a / b["size"]), done(a, 0)))
            .otherwise(then(item(a, a["p"] - up_b / a["size"]), done(b, 1)))
        )

    return F.aggregate(items, start, meet)


def round_dependently(items: DataFrame, fan_in: int = 128) -> DataFrame:
    """group, rid, rid2, size, p (in [0, 1)) -> rid, rid2, up: 1 for each item
    rounded up.

    rid and rid2 together tell items apart; blocks, the order inside them and the
    random numbers depend on them only. `items` should be cut already. Each level
    groups about `fan_in` items of a group; the rests go one level up."""
    done, level = None, 0
    largest = items.groupBy("group").count().agg(F.max("count")).first()[0] or 0
    while largest:
        # Blocks of a group are told apart by a hash of the row: a hot group has more blocks, not larger ones.
        blocks = -(-largest // fan_in)
        block = F.lit(0) if largest <= fan_in else F.pmod(F.xxhash64("rid", "rid2", F.lit(level)), F.lit(blocks))
        folded = cut(
            items.groupBy("group", block.alias("block"))
            .agg(F.sort_array(F.collect_list(F.struct("size", "rid", "rid2", "p")), asc=False).alias("items"))
            .select("group", _fold(F.col("items"), level).alias("f"))
            .select("group", "f.rest", "f.out")
        )
        here = folded.select(F.inline("out"))
        done = here if done is None else done.unionByName(here)
        items = folded.select("group", "rest.*")
        if largest <= fan_in:
            last = items.select("rid", "rid2", (unit(F.lit(-1), "rid", "rid2") < F.col("p")).cast("int").alias("up"))
            return done.unionByName(last)
        largest, level = blocks, level + 1
    return items.select("rid", "rid2", F.lit(0).alias("up"))


def numbered(rows: DataFrame) -> DataFrame:
    """Fixed rows with _rid and _rid2, 128 bits of hash of a row's content, and _part,
    the partition that a row was written from, which goes: rows with the same content
    get other second numbers, by their places among themselves. As such rows are the
    same, it doesn't matter which is which, and the result depends on the rows only,
    not on how they are dealt out.

    Copies are numbered inside their partitions, from where the copies in partitions
    before end. Rows meet the table of repeated contents by partition, too, so a
    content with a third of all rows is no task's alone, whether that table is
    broadcast or not."""
    again = rows.groupBy("_rid", "_rid2").count().filter("count > 1")
    if again.isEmpty():
        return rows.drop("_part")
    whole = Window.partitionBy("_rid", "_rid2")
    before = F.coalesce(F.sum("_n").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = rows.groupBy("_rid", "_rid2", "_part").agg(F.count("*").alias("_n"))
    parts = parts.select("_rid", "_rid2", "_part", before.alias("_before"), F.sum("_n").over(whole).alias("_all"))
    repeated = checked_broadcast(cut(parts.filter("_all > 1").drop("_all")))
    by = ["_rid", "_rid2", "_part"]
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.lit(1))) + F.col("_before")
    told = rows.join(repeated, by).withColumn("_rid2", F.xxhash64("_rid2", place)).select(*quoted(rows.columns))
    return rows.join(repeated, by, "left_anti").unionByName(told).drop("_part")


def mix(
    docs: DataFrame, ratio: float = 1.5, weights=(3, 1, 2), cap: float = 2.0, keep: tuple[str, ...] = (), fan_in: int = 128
) -> DataFrame:
    """doc_id, source, the columns `keep`, size, source_size, target, copies,
    taken (= copies * size) for each row of `docs`."""
    content = ["doc_id", "source", text_of(), *keep]
    ids = [F.xxhash64(F.lit(seed), *content).alias(f"_rid{seed}") for seed in ("", "2")]
    sized = docs.select("doc_id", "source", *keep, F.size(words_of(text_of())).cast("long").alias("size"), *ids, F.spark_partition_id().alias("_part"))
    if keep:  # wide rows are kept compressed and by columns
        path = shared_folder(docs, "sized")
        sized.write.parquet(path)
        sized = docs.sparkSession.read.parquet(path)
    else:
        sized = cut(sized)
    sized = numbered(sized)  # written before, so copies keep their partitions
    by_source = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, ratio, cap)
    by_source = checked_broadcast(cut(by_source.withColumnRenamed("source", "_source")), 100_000)
    expected = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    rows = (
        sized.join(by_source, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("_whole", F.floor(expected))
        .withColumn("_p", expected - F.col("_whole"))
    )
    fractions = rows.filter("_p > 0 AND size > 0").select(
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")).alias("group"), F.col("_rid").alias("rid"), F.col("_rid2").alias("rid2"),
        "size", F.col("_p").alias("p"),
    )
    ups = round_dependently(fractions, fan_in).withColumnsRenamed({"rid": "_rid", "rid2": "_rid2"})
    return (
        rows.join(checked_broadcast(ups), ["_rid", "_rid2"], "left")
        .withColumn("copies", F.when(F.col("size") > 0, F.col("_whole") + F.coalesce("up", F.lit(0))).otherwise(F.lit(0)).cast("long"))
        .select("doc_id", "source", *keep, "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )
