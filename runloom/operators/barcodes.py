"""Barcode counts, ranks, sample lookup, matching, collisions and reports.

Counts are looked at by lane, where a missing lane is a lane like any other, and,
after `scoped`, over all lanes too: a column `scope` then says `lane` or `all`.
Whatever is grouped or joined by lane is so by scope and lane, nulls together, so a
report of each lane and one of the whole come from the same pass.

The sample sheet has a row for each sample and lane, some thousands at most; it
is left to Spark to broadcast it by its size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import barcodes as B
from ..sources.shared import BROADCAST_ROWS, checked_broadcast, cut


def keys_of(df: DataFrame) -> list[str]:
    """By which barcodes are ranked, matched and reported."""
    return [c for c in ("scope", "lane") if c in df.columns]


def meet(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """A join by columns of equal names in which null meets null; the right ones go."""
    names = {c: f"_right_{c}" for c in on}
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()])
    out = left.join(right.withColumnsRenamed(names), same, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*names.values())


def scoped(found: DataFrame) -> DataFrame:
    """Counts by lane, and those over all lanes (lane null), told apart by `scope`."""
    both = found.groupingSets([[F.col("lane"), F.col("barcode")], [F.col("barcode")]], "lane", "barcode")
    scope = F.when(F.grouping("lane") == 1, "all").otherwise("lane")
    return both.agg(F.sum("n").alias("n"), scope.alias("scope")).select("scope", "lane", "barcode", "n")


def sheet_of(found: DataFrame, sheet: DataFrame) -> DataFrame:
    """The sheet's rows for the lanes of `found`: rows without a lane are for each of
    its lanes, of which there are a few; over all lanes each sample and index once.
    `_own` tells rows of the lane's own."""
    keys, columns = keys_of(found), [c for c in ("sample", "project", "index_seq", "line_no", "seed_order") if c in sheet.columns]
    scope = [F.lit("lane").alias("scope")] if "scope" in keys else []
    rows = sheet.filter("lane IS NOT NULL").select(*scope, "lane", *columns, F.lit(True).alias("_own"))
    lanes = found.select(keys).distinct()
    lanes = lanes.filter("scope = 'lane'") if scope else lanes
    everywhere = sheet.filter("lane IS NULL").select(*columns, F.lit(False).alias("_own")).join(F.broadcast(lanes))
    rows = rows.unionByName(everywhere)
    if scope:
        by = [c for c in ("sample", "project", "index_seq") if c in columns]
        rest = [F.min(c).alias(c) for c in columns if c not in by]
        once = sheet.groupBy(by).agg(F.lit(True).alias("_own"), *rest)
        rows = rows.unionByName(once.withColumns({"scope": F.lit("all"), "lane": F.lit(None).cast("int")}))
    return rows


def counts(reads: DataFrame) -> DataFrame:
    return reads.groupBy("lane", "barcode").agg(F.count("*").alias("n"))


def counts_at_both_grains(reads: DataFrame) -> DataFrame:
    """By lane and barcode, and by barcode over all lanes (lane null), at once."""
    by = [[F.col("lane"), F.col("barcode")], [F.col("barcode")]]
    return reads.groupingSets(by, "lane", "barcode").agg(F.count("*").alias("n"))


def pooled(*tables: DataFrame) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out.groupBy("lane", "barcode").agg(F.sum("n").alias("n"))


def totals(found: DataFrame) -> DataFrame:
    return found.agg(F.sum("n").alias("n_reads"), F.countDistinct("lane").alias("n_lanes"))


def placed(found: DataFrame) -> DataFrame:
    """lane, barcode, n, ... -> also rank (by count in the lane, ties by barcode), the
    lane's total and the running sum in rank order.

    Rows are dealt out by ranges of their order, once, and written; a row's number in
    its range is known then. Rows of a lane with equal counts in a range are a run;
    the runs, far fewer, are summed up in order, and a row's place is its run's and
    its distance from the run's first row. No task has more than a range."""
    keys = keys_of(found)
    order = [*[F.asc_nulls_first(k) for k in keys], F.desc("n"), F.asc("barcode")]
    dealt = found.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = cut(dealt.withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", 33)
    runs = dealt.groupBy(*keys, "n", part.alias("_part")).agg(F.count("*").alias("_c"), F.min("_id").alias("_first"))
    before = Window.partitionBy(*keys).orderBy(F.desc("n"), "_part").rowsBetween(Window.unboundedPreceding, -1)
    so_far = lambda x: F.coalesce(F.sum(x).over(before), F.lit(0))
    runs = runs.select(
        *keys, "n", "_part", "_first", so_far(F.col("_c")).alias("_before"), so_far(F.col("_c") * F.col("n")).alias("_sum"),
        F.sum(F.col("_c") * F.col("n")).over(Window.partitionBy(*keys)).alias("lane_total"),
    )
    place = F.col("_id") - F.col("_first") + 1
    rows = meet(dealt.withColumn("_part", part), checked_broadcast(runs), [*keys, "n", "_part"])
    return rows.select(*found.columns, (F.col("_before") + place).alias("rank"), "lane_total", (F.col("_sum") + place * F.col("n")).alias("cumulative"))


def ranked(found: DataFrame) -> DataFrame:
    """Rank by count in the lane, ties by barcode."""
    return placed(found).drop("lane_total", "cumulative")


def in_order(found: DataFrame) -> DataFrame:
    """Ranked barcodes as they are listed: by lane and rank."""
    return ranked(found).orderBy(*keys_of(found), "rank")


def shares(found: DataFrame) -> DataFrame:
    """Share of the lane and running sums in rank order."""
    return placed(found).drop("rank").withColumns(
        {"percent": B.percent(F.col("n"), F.col("lane_total")), "cumulative_percent": B.percent(F.col("cumulative"), F.col("lane_total"))}
    )


def with_totals(found: DataFrame) -> DataFrame:
    """With the lane's total: a row for each lane, brought to the rows."""
    keys = keys_of(found)
    return meet(found, checked_broadcast(found.groupBy(*keys).agg(F.sum("n").alias("lane_total"))), keys)


def above(found: DataFrame, cutoff: float) -> DataFrame:
    """Barcodes with at least floor(total * cutoff) reads of their lane."""
    return with_totals(found).filter(F.col("n") >= F.floor(F.col("lane_total") * cutoff))


def last_wins(sheet: DataFrame) -> DataFrame:
    """Of sheet rows with the same lane and index, the last; without line numbers the
    one with the last name."""
    by = "line_no" if "line_no" in sheet.columns else "sample"
    project = [F.max_by("project", by).alias("project")] if "project" in sheet.columns else []
    return sheet.groupBy("lane", "index_seq").agg(F.max_by("sample", by).alias("sample"), *project)


def with_samples(found: DataFrame, sheet: DataFrame) -> DataFrame:
    """The sample of each lane and index; sheet rows without a lane are for all lanes,
    where the lane has no row of its own for the index. Over all lanes the samples of
    any lane, as of `samples_over_lanes`."""
    keyed = last_wins(sheet).select("lane", F.col("index_seq").alias("barcode"), F.col("sample").alias("_own"))
    rows = meet(found, keyed.filter("lane IS NOT NULL"), ["lane", "barcode"], "left")
    rows = meet(rows, keyed.filter("lane IS NULL").select("barcode", F.col("_own").alias("_any")), ["barcode"], "left")
    sample = F.coalesce("_own", "_any")
    if "scope" in found.columns:
        rows = samples_over_lanes(rows, sheet)
        sample = F.when(F.col("scope") == "all", F.col("samples")).otherwise(sample)
    return rows.select(*found.columns, sample.alias("sample"))


def samples_over_lanes(found: DataFrame, sheet: DataFrame) -> DataFrame:
    """All-lanes lookup: the samples of any lane, comma-joined; null for none."""
    named = sheet.groupBy(F.col("index_seq").alias("barcode")).agg(F.array_join(F.sort_array(F.collect_set("sample")), ",").alias("samples"))
    return meet(found, named, ["barcode"], "left")


def closest_samples(groups: DataFrame, sheet: DataFrame, mismatches: int) -> DataFrame:
    """lane, barcode -> samples: exact, else all whose index is within reach. The
    pairs are those of a lane's few reference barcodes and its sheet."""
    keys = keys_of(groups)
    exact = with_samples(groups, sheet)
    rest = exact.filter(F.col("sample").isNull()).drop("sample")
    named = sheet_of(groups, sheet).select(*keys, "index_seq", F.col("sample").alias("near"))
    near = meet(rest, named, keys).filter(B.matches(F.col("index_seq"), F.col("barcode"), mismatches))
    listed = near.groupBy(*keys, "barcode").agg(F.array_join(F.sort_array(F.collect_set("near")), ",").alias("near"))
    return meet(exact, listed, [*keys, "barcode"], "left").withColumn("sample", F.coalesce("sample", "near")).drop("near")


#: Pairs of distinct barcodes and reference indexes that are tried one by one.
MOST_PAIRS = 50_000_000


def near_references(distinct: DataFrame, references: DataFrame, distance: int, most: int = MOST_PAIRS) -> DataFrame:
    """barcode, index_seq: pairs within the distance over the shorter length.

    Few pairs are all tried, the references brought to the barcodes. Otherwise both
    are cut into distance + 1 pieces, of which two within the distance share one;
    only those meet. Pieces depend on the two lengths, of which there are few."""
    refs = cut(references.select("index_seq").distinct())
    distinct = cut(distinct)
    near = B.hamming_truncated(F.col("barcode"), F.col("index_seq")) <= distance
    n_refs = refs.count()
    if n_refs <= BROADCAST_ROWS and n_refs * distinct.count() <= most:
        return distinct.join(F.broadcast(refs), near)
    sizes = lambda df, c: [r[0] for r in df.select(F.length(c)).distinct().collect()]
    of_barcodes, of_refs = sizes(distinct, "barcode"), sizes(refs, "index_seq")

    def cut_up(df: DataFrame, c: str, others: list[int]) -> DataFrame:
        with_other = df.withColumn("other", F.explode(F.array(*[F.lit(x) for x in others])))
        shorter = F.substring(F.col(c), F.lit(1), F.least(F.length(c), F.col("other")))
        return with_other.select(c, F.length(c).alias("own"), "other", F.inline(B.pieces(shorter, distance + 1)))

    a, b = cut_up(distinct, "barcode", of_refs), cut_up(refs, "index_seq", of_barcodes)
    b = b.select("index_seq", F.col("other").alias("own"), F.col("own").alias("other"), "k", "piece")
    return a.join(b, ["own", "other", "k", "piece"]).filter(near).select("barcode", "index_seq").distinct()


def assign(reads: DataFrame, references: DataFrame, distance: int, most: int = MOST_PAIRS) -> DataFrame:
    """Each read's first reference index (in order) within the distance over the
    shorter length, else `undetermined`. Distances are taken of distinct barcodes
    only; reads meet the result by equality."""
    best = _best_references(reads, references, distance, most)
    return reads.join(best, "barcode", "left").withColumn("assigned", F.coalesce("assigned", F.lit("undetermined")))


def _best_references(reads: DataFrame, references: DataFrame, distance: int, most: int = MOST_PAIRS) -> DataFrame:
    """barcode, assigned: brought to the reads where they are few, so that reads are not
    shuffled by their barcodes, of which some are frequent."""
    near = near_references(reads.select("barcode").distinct(), references, distance, most)
    return checked_broadcast(near.groupBy("barcode").agg(F.min("index_seq").alias("assigned")))


def assigned_pairs(first: DataFrame, second: DataFrame, references: DataFrame, distance: int, keep: tuple[str, ...] = (), barcodes: DataFrame | None = None) -> DataFrame:
    """barcode1, name_key, barcode2, error, assigned of reads 1 and 2 of equal name, and
    the columns `keep` of reads 1: assigned where the barcodes agree; otherwise they
    differ, or there is no partner. Pairs meet once. `barcodes` has those of reads 1,
    or more, where they are known with less work than by `first`."""
    one = first.select("name_key", F.col("barcode").alias("barcode1"), *keep)
    both = one.join(second.select("name_key", F.col("barcode").alias("barcode2")), "name_key", "full")
    missing = F.col("barcode1").isNull() | F.col("barcode2").isNull()
    both = both.withColumn("error", F.when(missing, "no partner").when(F.col("barcode1") != F.col("barcode2"), "barcodes differ"))
    best = _best_references(first if barcodes is None else barcodes, references, distance).withColumnRenamed("barcode", "barcode1")
    found = F.when(F.col("error").isNull(), F.coalesce("assigned", F.lit("undetermined")))
    return both.join(best, "barcode1", "left").withColumn("assigned", found)


def assign_pairs(first: DataFrame, second: DataFrame, references: DataFrame, distance: int) -> tuple[DataFrame, DataFrame]:
    """Reads 1 and 2 of equal name: those whose barcodes agree, assigned, and the
    errors: those whose barcodes differ, and those without a partner."""
    pairs = assigned_pairs(first, second, references, distance)
    good = pairs.filter("error IS NULL").select(F.col("barcode1").alias("barcode"), "name_key", "assigned")
    return good, pairs.filter("error IS NOT NULL").select("name_key", "barcode1", "barcode2", "error")


def ambiguous(references: DataFrame, distance: int, most: int = MOST_PAIRS) -> DataFrame:
    """Pairs of reference indexes that a barcode could be assigned to alike, found as
    `near_references` finds them: all tried, or by shared pieces."""
    refs = references.select("index_seq").distinct()
    near = near_references(refs.withColumnRenamed("index_seq", "barcode"), refs, distance, most).filter("barcode < index_seq")
    d = B.hamming_truncated(F.col("barcode"), F.col("index_seq"))
    return near.select(F.col("barcode").alias("index_a"), F.col("index_seq").alias("index_b"), d.alias("distance"))


def collisions(sheet: DataFrame, mismatches: int | Column, use: str = "all") -> DataFrame:
    """Pairs of sheet rows of a lane (of all rows, if lanes are not given) whose
    indexes differ in fewer than 2m + 1 places over the shorter one; rows without
    an index are skipped. `use`: `all` joins both indexes, `1` takes i7, `2` i5. Rows
    are told apart by `line_no`, if given; else by sample and index."""
    limit = F.lit(mismatches) if isinstance(mismatches, int) else mismatches
    parts = F.split("index_seq", r"\+")
    taken = {"all": B.plain(F.col("index_seq")), "1": F.get(parts, F.lit(0)), "2": F.get(parts, F.lit(1))}[use]
    place = F.col("line_no") if "line_no" in sheet.columns else F.struct("sample", "index_seq")
    rows = sheet.select("lane", "sample", taken.alias("i"), place.alias("p")).filter("i <> ''")
    a, b = rows.alias("a"), rows.alias("b")
    pairs = a.join(b, F.col("a.lane").eqNullSafe(F.col("b.lane")) & (F.col("a.p") < F.col("b.p")))
    d = B.hamming_truncated(F.col("a.i"), F.col("b.i"))
    out = pairs.select(
        F.col("a.lane").alias("lane"), F.col("a.sample").alias("sample_a"), F.col("b.sample").alias("sample_b"), d.alias("distance")
    )
    return out.filter(F.col("distance") < 2 * limit + 1)


def mismatch_limit(sheet: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """1 for a lane whose shortest index has 6 places or more, unless that makes
    indexes collide; else 0. Sheet rows without a lane are a lane of their own, and
    their limit is that of all lanes of the counts `found` that the sheet does not
    name; without such rows those lanes go by the shortest barcode of the counts."""
    shortest = sheet.groupBy("lane").agg(F.min(F.length("index_seq")).alias("shortest"))
    clash = collisions(sheet, 1).groupBy("lane").agg(F.count("*").alias("n_collisions"))
    known = meet(shortest, clash, ["lane"], "left")
    if found is not None:
        found = found.filter("scope = 'lane'") if "scope" in found.columns else found
        others = meet(found.groupBy("lane").agg(F.min(B.barcode_length(F.col("barcode"))).alias("_counted")), known, ["lane"], "left_anti")
        whole = known.filter("lane IS NULL").agg(F.count("*").alias("_given"), F.max("shortest").alias("_s"), F.max("n_collisions").alias("_c"))
        given = others.join(F.broadcast(whole)).select(
            "lane", F.when(F.col("_given") > 0, F.col("_s")).otherwise(F.col("_counted")).alias("shortest"), F.col("_c").alias("n_collisions")
        )
        known = known.unionByName(given)
    ok = (F.col("shortest") >= 6) & F.col("n_collisions").isNull()
    return known.select("lane", F.when(ok, 1).otherwise(0).alias("mismatches"))


def underrepresented(reported: DataFrame, sheet: DataFrame) -> DataFrame:
    """Sheet samples of a lane that no reported barcode has; with the reads of
    their barcode if it is reported still. Comma lists are taken apart first."""
    keys = keys_of(reported)
    found = reported.filter("sample IS NOT NULL").select(*keys, F.explode(F.split("sample", ",")).alias("sample")).distinct()
    kept = reported.select(*keys, F.col("barcode").alias("index_seq"), "n")
    rows = meet(sheet_of(reported, sheet).select(*keys, "sample", "index_seq"), found, [*keys, "sample"], "left_anti")
    return meet(rows, kept, [*keys, "index_seq"], "left").select(*keys, "sample", "index_seq", "n")


def overrepresented(reported: DataFrame) -> DataFrame:
    """Barcodes without a sample that rank above the lowest that has one."""
    keys = keys_of(reported)
    lowest = reported.filter("sample IS NOT NULL").groupBy(*keys).agg(F.max("rank").alias("_lowest"))
    return meet(reported, checked_broadcast(lowest), keys).filter("sample IS NULL AND rank < _lowest").drop("_lowest")


def report(found: DataFrame, sheet: DataFrame, cutoff: float = 0.001, all_lanes: bool = False) -> DataFrame:
    """Ranked barcodes above the cut-off with sample, share and running share of
    the lane's reads (as they were before the cut-off); with `all_lanes` also those
    over all lanes. What `found` is counted from is read once."""
    found = cut(scoped(found) if all_lanes else found)
    kept = above(found, cutoff)
    rows = placed(kept.withColumnRenamed("lane_total", "_all")).drop("lane_total").withColumnRenamed("_all", "lane_total")
    return with_samples(rows, sheet).withColumns(
        {"percent": B.percent(F.col("n"), F.col("lane_total")), "cumulative_percent": B.percent(F.col("cumulative"), F.col("lane_total"))}
    )


def coverage(found: DataFrame, listed: DataFrame, name: str) -> DataFrame:
    """Each lane's reads, the number of listed barcodes (or groups), the reads that they
    cover, and the share; zeros where nothing is listed."""
    keys = keys_of(found)
    sums = listed.groupBy(*keys).agg(F.count("*").alias(name), F.sum("n").alias("coverage"))
    rows = meet(found.groupBy(*keys).agg(F.sum("n").alias("total_reads")), sums, keys, "left")
    rows = rows.withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in (name, "coverage")})
    return rows.withColumn("coverage_percent", B.percent(F.col("coverage"), F.col("total_reads")))


def summary(found: DataFrame, reported: DataFrame, sheet: DataFrame) -> DataFrame:
    """A row for each report: reads, barcodes, coverage, and its problems. `found` has
    the scopes of `reported`."""
    reported = cut(reported)  # read several times
    keys = keys_of(reported)
    flags = problems(reported, sheet)
    rows = meet(coverage(found, reported, "n_barcodes"), flags, keys, "left")
    return rows.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_under", "n_over")} | {"has_problems": F.coalesce("has_problems", F.lit(False))})


def analyse(found: DataFrame, groups: DataFrame, sheet: DataFrame, mismatches: int) -> tuple[DataFrame, DataFrame]:
    """Groups (lane, barcode, n, n_sequences) with sample, rank and shares, and for each
    lane its reads, its groups and the reads that they cover. `found` has the scopes
    of `groups`."""
    keys = keys_of(groups)
    rows = placed(groups).drop("lane_total")
    rows = meet(closest_samples(rows, sheet, mismatches), found.groupBy(*keys).agg(F.sum("n").alias("total_reads")), keys)
    rows = rows.withColumns({"percent": B.percent(F.col("n"), F.col("total_reads")), "cumulative_percent": B.percent(F.col("cumulative"), F.col("total_reads"))})
    return rows, coverage(found, groups, "n_groups")


def problems(reported: DataFrame, sheet: DataFrame) -> DataFrame:
    """lane -> whether samples are missing or unknown barcodes abound: the lanes of the
    sheet and of the report."""
    reported = cut(reported)  # read several times
    keys = keys_of(reported)
    lanes = sheet_of(reported, sheet).select(keys).union(reported.select(keys)).distinct()
    under = underrepresented(reported, sheet).groupBy(*keys).agg(F.count("*").alias("n_under"))
    over = overrepresented(reported).groupBy(*keys).agg(F.count("*").alias("n_over"))
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    return meet(meet(lanes, under, keys, "left"), over, keys, "left").select(
        *keys, n("n_under").cast("long").alias("n_under"), n("n_over").cast("long").alias("n_over"), (n("n_under") + n("n_over") > 0).alias("has_problems")
    )
