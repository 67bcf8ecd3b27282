"""Pairing, grouping and merging of files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names as N


def attributes(extract, path: Column) -> dict[str, Column]:
    """What an extractor of name attributes gives for a path: a dict of columns, or a
    struct column with fields of the same names. What it lacks is null."""
    found = extract(path)
    get = found.get if isinstance(found, dict) else lambda k, _: found[k]
    none = {k: F.lit(None).cast("int") for k in ("sample_number", "lane_number", "read_number", "set_number")} | {"is_index_read": F.lit(False)}
    return {k: get(k, none.get(k, F.lit(None).cast("string"))) for k in KEPT}


KEPT = ("sample_name", "sample_number", "barcode_sequence", "lane_number", "read_number", "set_number", "is_index_read")


def stem(path: Column, extract=N.illumina_attrs) -> Column:
    """Directory, and the name with read 1: what files of one set share. An extractor
    that can rebuild names (`names.CustomNames`) does so itself."""
    folder = F.regexp_extract(path, "^(.*/)?[^/]*$", 1)
    if hasattr(extract, "renamed"):
        return F.concat(folder, extract.renamed(path, F.lit(1)))
    a = attributes(extract, path) | {"read_number": F.lit(1), "is_index_read": F.lit(False)}
    return F.concat(folder, N.rebuilt(*[a[k] for k in KEPT]))


def pairs_by_name(files: DataFrame, extract=N.illumina_attrs) -> DataFrame:
    """fastq -> r1, r2 of equal name; those without a partner are kept."""
    a = attributes(extract, F.col("fastq"))
    keyed = files.select("fastq", stem(F.col("fastq"), extract).alias("stem"), a["read_number"].alias("read"), a["is_index_read"].alias("index")).filter("NOT index")
    one = keyed.filter("read = 1").select("stem", F.col("fastq").alias("r1"))
    return one.join(keyed.filter("read = 2").select("stem", F.col("fastq").alias("r2")), "stem", "full").select("r1", "r2")


def pairs_by_header(reads: DataFrame) -> DataFrame:
    """file -> r1, r2 whose first reads share their name. Empty files have no row."""
    first = reads.groupBy("file").agg(F.min_by(F.struct("name_key", "read_number"), "read_idx").alias("f")).select("file", "f.*")
    one = first.filter("read_number = 1").select("name_key", F.col("file").alias("r1"))
    return one.join(first.filter("read_number = 2").select("name_key", F.col("file").alias("r2")), "name_key", "full").select("r1", "r2")


def sets_of_files(files: DataFrame, extract=N.illumina_attrs) -> DataFrame:
    """All files of one set: reads first, then index reads."""
    a = attributes(extract, F.col("fastq"))
    keyed = files.select(stem(F.col("fastq"), extract).alias("stem"), a["is_index_read"].alias("index"), a["read_number"].alias("read"), "fastq")
    return keyed.groupBy("stem").agg(F.array_sort(F.collect_list(F.struct("index", "read", "fastq"))).alias("files"))


def representatives(files: DataFrame) -> DataFrame:
    """One file of each set, so that nothing is counted twice."""
    return sets_of_files(files).select("stem", F.get("files", F.lit(0))["fastq"].alias("fastq"))


def merged_lanes(files: DataFrame) -> DataFrame:
    """The files that become one when a sample's lanes are merged."""
    name = N.changed(F.col("fastq"), lane_number=None)
    return files.groupBy(name.alias("merged")).agg(F.count("*").alias("n_files"), F.sum("n_reads").alias("n_reads"))


def missing(expected: DataFrame, present: DataFrame, on) -> DataFrame:
    return expected.join(present, on, "left_anti")


def select_files(files: DataFrame, selectors, extract=N.illumina_attrs) -> DataFrame:
    """`r1`, `i2`, `r*`, `i*`, `*`: names, distinct and in order."""
    a = attributes(extract, F.col("fastq"))
    keep = F.lit(False)
    for s in selectors:
        kind = F.lit(True) if s == "*" else a["is_index_read"] == (s[0].lower() == "i")
        keep = keep | (kind if s in ("*",) or s[1:] == "*" else kind & (a["read_number"] == int(s[1:])))
    return files.filter(keep).select("fastq").distinct().orderBy("fastq")


def expected_outputs(files: DataFrame, rules: list[tuple], extract=N.illumina_attrs) -> DataFrame:
    """module, fastq, suffix: what quality tools should have made of each file. Rules,
    a short list, are (module, suffix, reads): of files of those read numbers; with
    None of all that are no index reads."""
    a = attributes(extract, F.col("fastq"))
    wanted = [
        F.when(~a["is_index_read"] & (F.lit(True) if reads is None else a["read_number"].isin(list(reads))), F.struct(F.lit(module).alias("module"), F.lit(suffix).alias("suffix")))
        for module, suffix, reads in rules
    ]
    return files.select("fastq", F.inline(F.array_compact(F.array(*wanted)))).select("module", "fastq", "suffix")


def completeness(files: DataFrame, expected: DataFrame, present: DataFrame) -> DataFrame:
    """fastq; module, fastq, suffix of each expected output; fastq, suffix found ->
    fastq, n_expected, n_missing, ok (null where nothing is expected)."""
    rows = expected.select("fastq", "suffix").distinct()
    gone = missing(rows, present, ["fastq", "suffix"]).groupBy("fastq").agg(F.count("*").alias("n_missing"))
    sums = rows.groupBy("fastq").agg(F.count("*").alias("n_expected")).join(gone, "fastq", "left")
    n = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    out = files.select("fastq").distinct().join(sums, "fastq", "left").select("fastq", n("n_expected"), n("n_missing"))
    return out.withColumn("ok", F.when(F.col("n_expected") > 0, F.col("n_missing") == 0))


def verdict(modules: DataFrame, expected: DataFrame, present: DataFrame) -> DataFrame:
    """module, n_expected, n_missing, ok of every module, null where nothing is
    expected of it, and in the row without a module those of all: ok unless a module
    is not."""
    rows = expected.select("module", "fastq", "suffix").distinct()
    gone = missing(rows, present, ["fastq", "suffix"]).groupBy("module").agg(F.count("*").alias("n_missing"))
    sums = rows.groupBy("module").agg(F.count("*").alias("n_expected")).join(gone, "module", "left")
    each = modules.select("module").distinct().join(sums, "module", "left")
    n = lambda c: F.sum(F.coalesce(c, F.lit(0))).cast("long").alias(c)
    out = each.rollup("module").agg(n("n_expected"), n("n_missing"), F.grouping("module").alias("_all"))
    ok = F.when((F.col("n_expected") > 0) | (F.col("_all") == 1), F.col("n_missing") == 0)
    return out.withColumn("ok", ok).drop("_all")


UNDETERMINED = "Undetermined_indices"


def merge_trees(primary: DataFrame, extras: DataFrame, lanes_split: bool = True) -> tuple[DataFrame, DataFrame]:
    """project, sample, tree, … -> the merged rows and the conflicts.

    A project of an extra tree takes the primary one's place; a project in several
    extra trees is a conflict, and none of its rows is merged. Undetermined reads are
    concatenated if lanes are not split; else their samples are merged as projects are."""
    whole = F.col("project") != UNDETERMINED
    entity = F.when(whole, F.lit(None).cast("string")).otherwise(F.col("sample")).alias("_sample")
    keys = ["project", "_sample"]
    x, p = extras.withColumn("_sample", entity), primary.withColumn("_sample", entity)
    apart = lambda df: df if lanes_split else df.filter(whole)
    counted = apart(x).groupBy(*keys).agg(F.countDistinct("tree").alias("n_trees"))
    conflicts = counted.filter("n_trees > 1")
    told = counted.select(F.col("project").alias("_p"), F.col("_sample").alias("_s"), F.col("n_trees"))
    same = F.expr("project = _p AND _sample <=> _s")
    merged = apart(x).join(told.filter("n_trees = 1"), same, "left_semi").unionByName(apart(p).join(told, same, "left_anti").select(x.columns))
    if not lanes_split:
        merged = merged.unionByName(x.filter(~whole)).unionByName(p.filter(~whole).select(x.columns))
    return merged.select(primary.columns), conflicts.withColumnRenamed("_sample", "sample")


def mixed_formats(files: DataFrame, extract=N.illumina_attrs) -> DataFrame:
    """tree, has_lanes, n_files: the kinds of names, if trees mix names with and
    without a lane, which can't be merged; no row otherwise."""
    lane = attributes(extract, F.col("fastq"))["lane_number"]
    kinds = files.groupBy("tree", lane.isNotNull().alias("has_lanes")).agg(F.count("*").alias("n_files"))
    mixed = kinds.agg((F.countDistinct("has_lanes") > 1).alias("_mixed"))
    return kinds.join(F.broadcast(mixed)).filter("_mixed").drop("_mixed")
