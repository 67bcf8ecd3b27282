"""Read statistics by file, lane, project and sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.barcodes import percent

UNDETERMINED = "Undetermined_indices"


def first_reads(files: DataFrame) -> DataFrame:
    """Read 1, and no index reads."""
    return files.filter((F.col("read_number") == 1) & ~F.col("is_index"))


def biological(files: DataFrame) -> DataFrame:
    return files.filter(~F.col("is_index"))


def in_lanes(files: DataFrame, lanes) -> DataFrame:
    """A file without a lane in its name is kept."""
    return files.filter(F.col("lane").isNull() | F.col("lane").isin(list(lanes)))


def reads_per_file(reads: DataFrame) -> DataFrame:
    """With the grand total in the row whose file is null."""
    return reads.rollup("file").agg(F.count("*").alias("n_reads"))


def reads_per_lane(reads: DataFrame, file_lane: Column | None = None) -> DataFrame:
    """By file and lane: the name's lane, else the header's."""
    lane = F.coalesce(file_lane, F.col("lane")) if file_lane is not None else F.col("lane")
    return reads.groupBy("project", "sample", "file", lane.alias("lane")).agg(F.count("*").alias("n_reads"))


def full_stats(per_lane: DataFrame, lanes) -> DataFrame:
    """One column for each lane, L1 to Ln, and the total; no reads is null."""
    cells = [F.sum(F.when(F.col("lane") == n, F.col("n_reads"))).alias(f"L{n}") for n in lanes]
    return per_lane.groupBy("project", "sample", "file").agg(F.sum("n_reads").alias("n_reads"), *cells)


def lane_samples(reads: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """Reads of each sample in each lane, their share of the lane (1 decimal; null
    in an empty lane) and the lane's total. Expected samples (lane, project,
    sample) without reads get a row with 0."""
    found = reads.groupBy("lane", "project", "sample").agg(F.count("*").alias("n_reads"))
    if expected is not None:
        keys = ["lane", "project", "sample"]
        missing = expected.select(keys).distinct().join(found, keys, "left_anti")
        found = found.unionByName(missing.withColumn("n_reads", F.lit(0).cast("long")))
    total = F.sum("n_reads").over(Window.partitionBy("lane"))
    share = F.round(percent(F.col("n_reads"), F.col("total_reads")), 1)
    return found.withColumn("total_reads", total).withColumn("percent", share)


def lane_samples_report(reads: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """The same in the order of the report: by lane, project and sample."""
    return lane_samples(reads, expected).orderBy("lane", "project", "sample")


def lane_summary(reads: DataFrame) -> DataFrame:
    """Total, assigned and unassigned reads of each lane, with percentages (2
    decimals, 0 in an empty lane). One shuffle of partial counts by lane."""
    none = F.col("project") == UNDETERMINED
    sums = reads.groupBy("lane").agg(
        F.count("*").alias("total_reads"), F.count(F.when(~none, 1)).alias("assigned_reads"), F.count(F.when(none, 1)).alias("unassigned_reads")
    )
    share = lambda c: F.round(F.coalesce(percent(F.col(c), F.col("total_reads")), F.lit(0.0)), 2)
    return sums.withColumns({"percent_assigned": share("assigned_reads"), "percent_unassigned": share("unassigned_reads")})


def inherit_counts(files: DataFrame, per_lane: DataFrame, stem: Column, first_stem: Column) -> DataFrame:
    """Files of other reads get the lane counts of the file of read 1 with the same
    name: an equality of rebuilt names."""
    return files.withColumn("_first", stem).join(per_lane.withColumn("_first", first_stem).drop("file"), "_first").drop("_first")


def upsert(old: DataFrame, new: DataFrame, keys) -> DataFrame:
    """New rows win over old ones with equal keys. The columns are those of both, as
    of tables with a column for each lane; what a row's table lacks is null."""
    keys = list(keys)
    values = [c for c in old.columns if c not in keys] + [c for c in new.columns if c not in {*keys, *old.columns}]
    side = lambda df, name: df.select(*keys, F.struct(F.lit(True).alias("_here"), *[F.col(v) for v in values if v in df.columns]).alias(name))
    both = side(old, "o").join(side(new, "n"), keys, "full")
    pick = lambda name, df, v: F.col(f"{name}.{v}") if v in df.columns else F.lit(None)
    return both.select(*keys, *[F.when(F.col("n._here"), pick("n", new, v)).otherwise(pick("o", old, v)).alias(v) for v in values])


def warnings(per_sample: DataFrame, lanes: DataFrame) -> DataFrame:
    """Lanes without samples, lanes with an empty sample."""
    worst = per_sample.groupBy("lane").agg(F.min("n_reads").alias("least"))
    return lanes.select("lane").distinct().join(worst, "lane", "left").select(
        "lane", F.col("least").isNull().alias("no_samples"), F.coalesce(F.col("least") == 0, F.lit(False)).alias("empty_sample")
    )


def file_warnings(expected: DataFrame, per_lane: DataFrame) -> DataFrame:
    """project, sample, file, lane expected (lane null: of any lane); counts of
    `reads_per_lane` -> project, sample, file, empty_lanes (those without reads, in
    order), warning: a lane of the file, or the whole file, has no reads."""
    keys = ["project", "sample", "file"]
    counted = per_lane.groupBy(*keys, "lane").agg(F.sum("n_reads").alias("n_reads"))
    lanes = expected.select(*keys, "lane").filter("lane IS NOT NULL").distinct().join(counted, [*keys, "lane"], "left")
    # Lanes that were counted though they were not expected count as well.
    lanes = lanes.unionByName(counted.join(expected.filter("lane IS NOT NULL"), [*keys, "lane"], "left_anti"))
    none = F.coalesce("n_reads", F.lit(0)) == 0
    sums = lanes.groupBy(*keys).agg(F.sort_array(F.collect_set(F.when(none, F.col("lane")))).alias("empty_lanes"), F.sum("n_reads").alias("_n"))
    out = expected.select(keys).union(per_lane.select(keys)).distinct().join(sums, keys, "left")
    empty = F.coalesce("empty_lanes", F.array().cast("array<int>"))
    return out.select(*keys, empty.alias("empty_lanes"), ((F.size(empty) > 0) | (F.coalesce("_n", F.lit(0)) == 0)).alias("warning"))


def blank_repeats(rows: DataFrame) -> DataFrame:
    """In report order, a project's name is shown in its first row of a lane only."""
    before = F.lag("project").over(Window.partitionBy("lane").orderBy("project", "sample"))
    return rows.withColumn("shown_project", F.when(before.eqNullSafe(F.col("project")), "").otherwise(F.col("project")))


def disk_usage(inventory: DataFrame) -> DataFrame:
    """Bytes by investigator and project, with subtotals and a grand total."""
    return inventory.rollup("pi", "project").agg(F.sum("size_bytes").alias("bytes"), F.grouping_id().alias("level"))
