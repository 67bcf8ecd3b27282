"""Sample sheet checks, project registry and reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import barcodes as B
from ..functions import names as N
from ..sources.shared import BROADCAST_ROWS, cut
from ..sources.tables import sheet_numbers

#: Other names of the number of cells, the preferred first.
CELL_METRICS = ("Estimated Number of Cells", "Estimated number of cells", "annotated_cells", "Cells")


def set_where(sheet: DataFrame, column: str, value: Column, lanes=None, where: tuple[str, str] | None = None) -> DataFrame:
    """A column is set in rows of the lanes whose other column fits a glob."""
    here = F.lit(True) if lanes is None else F.col("lane").isin(list(lanes))
    if where is not None:
        here = here & N.glob_like(F.col(where[0]), where[1])
    return sheet.withColumn(column, F.when(here, value).otherwise(F.col(column)))


def incomplete(sheet: DataFrame, columns=("lane", "sample", "sample_name", "project")) -> DataFrame:
    """Rows with a blank where the first row has something, in those of the columns
    that the sheet has."""
    columns = [c for c in columns if c in sheet.columns]
    blank = lambda c: F.coalesce(F.trim(c.cast("string")), F.lit("")) == ""
    first = sheet.agg(*[F.min_by(F.struct(F.col(c).alias("v")), "line_no")["v"].alias(f"_{c}") for c in columns])
    bad = reduce(lambda a, b: a | b, [~blank(F.col(f"_{c}")) & blank(F.col(c)) for c in columns])
    return sheet.join(F.broadcast(first)).filter(bad).select(sheet.columns)


def bad_barcodes(sheet: DataFrame) -> DataFrame:
    return sheet.filter(~F.forall(F.split("index_seq", r"\+"), B.is_valid))


def several(rows: DataFrame, of: str, by) -> DataFrame:
    """Groups with more than one distinct value."""
    return rows.groupBy(*by).agg(F.array_sort(F.collect_set(of)).alias("found")).filter(F.size("found") > 1)


def predicted_outputs(sheet: DataFrame) -> DataFrame:
    """project, sample, index_seq, lanes; and sample_number, by first appearance, if
    the sheet has line numbers."""
    lanes = F.array_join(F.array_sort(F.collect_set("lane")).cast("array<string>"), ",")
    found = sheet.groupBy("project", "sample", "index_seq").agg(lanes.alias("lanes"))
    return found.join(sheet_numbers(sheet), "sample") if "line_no" in sheet.columns else found


def summary_by_lane(sheet: DataFrame) -> DataFrame:
    """Samples of a project in a lane, the shape of their indexes and whether
    shapes are mixed."""
    shape = B.masked_shape(F.col("index_seq"))
    return sheet.groupBy("project", "lane").agg(
        F.countDistinct("sample").alias("n_samples"), F.min(shape).alias("index_shape"), (F.countDistinct(shape) > 1).alias("mixed")
    )


#: Pairs of names that are tried one by one.
MOST_PAIRS = 50_000_000


def likeness(x: Column, y: Column) -> Column:
    """By edit distance over the longer name."""
    return 1 - F.try_divide(F.levenshtein(x, y), F.greatest(F.length(x), F.length(y)))


def candidate_pairs(names: DataFrame, least: float) -> DataFrame:
    """long, short: pairs of different names that may be so much alike, each once.

    Of two names so much alike the shorter one, cut into a piece more than there may be
    edits, keeps a piece whole, and the longer one has it no further off than there
    may be edits. So names meet by lengths, number and text of a piece. Lengths are few,
    and so are the pairs of them that differ by no more edits than they allow."""
    sizes = sorted(r[0] for r in names.select(F.length("name")).distinct().limit(10_000).collect())
    edits = {n: int((1 - least) * n + 1e-6) for n in sizes}
    pairs = [(n, m, edits[n]) for n in sizes for m in sizes if n - edits[n] <= m <= n]
    if not pairs:
        return names.select(F.col("name").alias("long"), F.col("name").alias("short")).limit(0)
    plan = names.sparkSession.createDataFrame(pairs, "n int, m int, e int")
    start, size = lambda k: F.floor(F.col("m") * k / (F.col("e") + 1)).cast("int"), lambda k: (F.floor(F.col("m") * (k + 1) / (F.col("e") + 1)) - F.floor(F.col("m") * k / (F.col("e") + 1))).cast("int")
    met = lambda side, length: names.withColumn(length, F.length("name")).join(F.broadcast(plan), length).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("e"))))
    short = met("short", "m").select("n", "m", "k", F.substring("name", start(F.col("k")) + 1, size(F.col("k"))).alias("piece"), F.col("name").alias("short"))
    low, high = F.greatest(start(F.col("k")) - F.col("e"), F.lit(0)), F.least(start(F.col("k")) + F.col("e"), F.col("n") - size(F.col("k")))
    there = F.when(low <= high, F.array_distinct(F.transform(F.sequence(low, high), lambda i: F.substring(F.col("name"), i + 1, size(F.col("k"))))))
    long = met("long", "n").select("n", "m", "k", F.col("name").alias("long"), F.explode(there).alias("piece"))
    both = long.join(short, ["n", "m", "k", "piece"]).filter((F.col("n") > F.col("m")) | (F.col("long") < F.col("short")))
    return both.select("long", "short").distinct()


def close_names(projects: DataFrame, least: float = 0.6, top: int = 3, most: int = MOST_PAIRS) -> DataFrame:
    """Similar project names, the closest three of each. Likeness is by edit
    distance over the longer name. Few pairs are all tried; else only those of
    `candidate_pairs`."""
    names = cut(projects.select(F.col("project").alias("name")).filter("name IS NOT NULL").distinct())
    n = names.count()
    if n <= BROADCAST_ROWS and n * n <= most:
        pairs = names.select(F.col("name").alias("long")).join(F.broadcast(names.select(F.col("name").alias("short"))), F.col("long") < F.col("short"))
    else:
        pairs = candidate_pairs(names, least)
    near = pairs.withColumn("likeness", likeness(F.col("long"), F.col("short"))).filter(F.col("likeness") >= least)
    both = F.explode(F.array(F.struct(F.col("long").alias("project"), F.col("short").alias("close")), F.struct(F.col("short").alias("project"), F.col("long").alias("close"))))
    rows = near.select(both.alias("x"), "likeness").select("x.project", "x.close", "likeness")
    rank = F.row_number().over(Window.partitionBy("project").orderBy(F.desc("likeness"), "close"))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= top)


def lint(sheet: DataFrame, least: float = 0.6) -> DataFrame:
    """One row for each check: name, n_found."""
    checks = {
        "several_barcodes": several(sheet, "index_seq", ("project", "sample")), "several_projects": several(sheet, "project", ("sample",)),
        "close_names": close_names(sheet.filter("project IS NOT NULL"), least), "incomplete": incomplete(sheet), "bad_barcodes": bad_barcodes(sheet),
        "bad_characters": sheet.filter(N.has_invalid_characters(F.concat_ws(",", "sample", "project", "index_seq"))),
    }
    rows = [df.agg(F.lit(name).alias("check"), F.count("*").alias("n_found")) for name, df in checks.items()]
    return reduce(DataFrame.unionByName, rows)


def missing_metadata(projects: DataFrame, required=("user_name", "pi", "organism", "library")) -> DataFrame:
    """project, item: required items that are not given; disabled rows are left out."""
    items = F.array(*[F.when(F.coalesce(F.trim(F.col(c)), F.lit(".")).isin(".", ""), F.lit(c)) for c in required])
    return projects.filter("NOT disabled").select("project", F.explode(F.array_compact(items)).alias("item"))


def matching(projects: DataFrame, column: str, pattern: str | None) -> DataFrame:
    """By glob; None: those without a value."""
    return projects.filter(F.col(column).isNull() if pattern is None else N.glob_like(F.col(column), pattern))


def linked(links: DataFrame, registry: DataFrame) -> DataFrame:
    """sample, reference -> the linked sample's row; `known` false if there is none.
    A reference without a run means the run at hand, `run` null in the registry."""
    parts = N.sample_reference(F.col("reference"))
    asked = links.select("sample", parts["run"].alias("run"), parts["project"].alias("project"), parts["sample"].alias("linked_sample"))
    have = registry.select(F.col("run").alias("_r"), F.col("project").alias("_p"), F.col("sample").alias("_s"), F.lit(True).alias("found")).distinct()
    found = asked.join(have, F.expr("run <=> _r AND project = _p AND linked_sample = _s"), "left")
    return found.select("sample", "run", "project", "linked_sample", F.coalesce("found", F.lit(False)).alias("known"))


def matching_runs(runs: DataFrame, wanted: str) -> DataFrame:
    """Analysis runs (path, run_name, platform, run_number, analysis_number) that a
    name, a path, a run's name, a run ID or `*` (any run) means."""
    name = F.element_at(F.split("path", "/"), -1)
    id_ = N.run_id(F.col("run_name"), F.col("platform"), F.col("run_number"), F.col("analysis_number"))
    any_run = F.lit(wanted == "*") & F.col("run_name").isNotNull()
    is_ = lambda x: F.coalesce(x == wanted, F.lit(False))
    return runs.filter(any_run | is_(F.col("path")) | is_(name) | is_(F.col("run_name")) | is_(id_))


def refreshed(table: DataFrame, outputs: DataFrame) -> DataFrame:
    """project, samples, disabled and project, samples found -> the new table: new
    projects come in, samples are updated, absent projects are disabled."""
    t = table.select("project", F.col("samples").alias("old"))
    o = outputs.select("project", F.col("samples").alias("new"), F.lit(True).alias("here"))
    return t.join(o, "project", "full").select("project", F.coalesce("new", "old").alias("samples"), F.col("here").isNull().alias("disabled"))


def sample_summary(files: DataFrame) -> DataFrame:
    """By project: number of samples, their names in natural order, and whether a
    sample has several files."""
    a = N.illumina_attrs(F.col("fastq"))
    kinds = files.select("project", "sample", F.struct(*[a[k].alias(k) for k in ("sample_number", "barcode_sequence", "lane_number", "set_number")]).alias("k")).distinct()
    per = kinds.groupBy("project", "sample").agg(F.count("*").alias("n"))
    names = F.transform(F.array_sort(F.collect_list(F.struct(N.natural_key(F.col("sample")).alias("o"), F.col("sample").alias("s")))), lambda x: x["s"])
    return per.groupBy("project").agg(F.count("*").alias("n_samples"), F.array_join(names, ", ").alias("samples"), (F.max("n") > 1).alias("several_files"))


def cell_counts(metrics: DataFrame) -> DataFrame:
    """project, sample, metric, value -> cells of a project by the first metric that
    a sample has; null if a sample has none."""
    rank = F.array_position(F.array(*[F.lit(x) for x in CELL_METRICS]), F.col("metric"))
    per = metrics.groupBy("project", "sample").agg(F.min_by(F.when(rank > 0, F.col("value")), F.when(rank > 0, rank).otherwise(F.lit(99))).alias("cells"))
    return per.groupBy("project").agg(F.when(F.count("cells") == F.count("*"), F.sum("cells")).alias("cells"))


def by_alias(metrics: DataFrame, aliases: DataFrame) -> DataFrame:
    """metric_alias(canonical, metric, priority): the preferred one of each sample."""
    hit = metrics.join(F.broadcast(aliases), "metric")
    return hit.groupBy("project", "sample", "canonical").agg(F.min_by("value", "priority").alias("value"))


def reads_per_cell(rows: DataFrame) -> DataFrame:
    """By reads in cells, else the mean, else the median; null where cells are 0."""
    return rows.withColumn("reads_per_cell", F.coalesce(F.try_divide("reads_in_cells", "cells"), "mean_reads", "median_reads"))


def project_report(projects: DataFrame, samples: DataFrame, cells: DataFrame, ends: DataFrame, multiplexed: DataFrame | None = None) -> DataFrame:
    """One line for each project: samples (those of multiplexed libraries if there are
    any; `?` if unknown), cells, whether reads are paired (`?` if unknown), names."""
    if multiplexed is None:
        multiplexed = projects.select("project").limit(0).withColumn("n_multiplexed", F.lit(0).cast("long"))
    rows = projects.join(samples, "project", "left").join(cells, "project", "left").join(multiplexed, "project", "left")
    rows = rows.join(ends.filter("project IS NOT NULL").select("project", "paired_end"), "project", "left")
    n = F.coalesce(F.when(F.col("n_multiplexed") > 0, F.col("n_multiplexed")), F.col("n_samples"))
    return rows.select(
        "project", "user_name", "pi", F.coalesce(n.cast("string"), F.lit("?")).alias("n_samples"), "cells",
        F.when(F.col("paired_end").isNull(), "?").when(F.col("paired_end"), "PE").otherwise("SE").alias("ends"),
        N.composite("/", F.col("organism"), F.col("library")).alias("kind"), F.coalesce("samples", F.lit("")).alias("samples"),
    )


def census(files: DataFrame) -> DataFrame:
    """What there is of each project: samples, reads, lanes, files."""
    return files.groupBy("project").agg(
        F.countDistinct("sample").alias("n_samples"), F.countDistinct("read_number", "is_index").alias("n_read_kinds"),
        F.countDistinct("lane").alias("n_lanes"), F.count("*").alias("n_files"), F.sum("n_reads").alias("n_reads"),
    )


def qc_census(files: DataFrame, outputs: DataFrame) -> DataFrame:
    """What a project's checks cover. `files`: project, sample, read_number, is_index;
    `outputs`: project, kind, organism, screen (null where it has none). Each in order:
    samples naturally, reads as `r1` and `i1`."""
    read = F.concat(F.when(F.col("is_index"), "i").otherwise("r"), F.coalesce("read_number", F.lit(1)).cast("string"))
    natural = F.transform(F.array_sort(F.collect_set(F.struct(N.natural_key(F.col("sample")).alias("k"), F.col("sample").alias("s")))), lambda x: x["s"])
    of_files = files.groupBy("project").agg(natural.alias("samples"), F.array_sort(F.collect_set(read)).alias("reads"))
    kinds = {"outputs": "kind", "organisms": "organism", "screens": "screen"}
    of_outputs = outputs.groupBy("project").agg(*[F.array_sort(F.collect_set(c)).alias(k) for k, c in kinds.items()])
    none = F.array().cast("array<string>")
    return of_files.join(of_outputs, "project", "full").select("project", *[F.coalesce(c, none).alias(c) for c in ("samples", "reads", *kinds)])


def biological_samples(projects: DataFrame) -> DataFrame:
    """listed, by_library, all (arrays) -> the samples with biological data: as
    listed, else by library, else all; known ones only."""
    some = lambda c: F.when(F.size(c) > 0, F.col(c))
    chosen = F.coalesce(some("listed"), some("by_library"), F.col("all"))
    return projects.select("project", F.array_sort(F.array_intersect(chosen, F.col("all"))).alias("samples"))


def library_checks(libraries: DataFrame, known_types: DataFrame) -> DataFrame:
    """config, sample, tag, feature_type -> config, check, value. Feature types are
    compared in lower case."""
    known_types = known_types.select(F.lower("feature_type").alias("type")).distinct()
    libraries = libraries.withColumn("type", F.lower("feature_type"))
    twice = lambda c: libraries.groupBy("config", c).agg(F.count("*").alias("n")).filter("n > 1").select("config", F.lit(f"duplicate_{c}").alias("check"), F.col(c).alias("value"))
    unknown = libraries.join(F.broadcast(known_types), "type", "left_anti").select("config", F.lit("unknown_type").alias("check"), F.col("feature_type").alias("value")).distinct()
    odd = libraries.filter(F.col("sample").rlike("[^A-Za-z0-9_-]")).select("config", F.lit("bad_characters").alias("check"), F.col("sample").alias("value")).distinct()
    known = libraries.join(F.broadcast(known_types), "type", "left_semi").groupBy("config", "type").agg(F.count("*").alias("n")).filter("n > 1")
    types = known.select("config", F.lit("duplicate_type").alias("check"), F.col("type").alias("value"))
    return reduce(DataFrame.unionByName, [twice("sample"), twice("tag"), types, unknown, odd])


def software(versions: DataFrame, fallback: DataFrame | None = None) -> DataFrame:
    """package -> sorted versions; packages that only the fallback has come from it."""
    rows = versions.select("package", "version")
    if fallback is not None:
        rows = rows.unionByName(fallback.select("package", "version").join(rows.select("package").distinct(), "package", "left_anti"))
    return rows.groupBy("package").agg(F.array_join(F.array_sort(F.collect_set("version")), ",").alias("versions"))


def paired_end(files: DataFrame) -> DataFrame:
    """By project, and for the run (project null): true only if all samples have
    read 2; true for a run without samples."""
    per = files.filter("NOT is_index").groupBy("project", "sample").agg(F.max(F.col("read_number") == 2).alias("paired"))
    run = per.agg(F.lit(None).cast("string").alias("project"), F.coalesce(F.bool_and("paired"), F.lit(True)).alias("paired_end"))
    return per.groupBy("project").agg(F.bool_and("paired").alias("paired_end")).unionByName(run)


def metadata_table(project: DataFrame, qc: DataFrame, run: DataFrame, items) -> DataFrame:
    """item, project, value: from the QC's metadata, else the project's, else the
    run's (one row)."""
    r = run.select(*[F.col(i).alias(f"r_{i}") for i in items])
    rows = project.select("project", *[F.col(i).alias(f"p_{i}") for i in items]).join(qc.select("project", *[F.col(i).alias(f"q_{i}") for i in items]), "project", "left").join(F.broadcast(r))
    told = F.array(*[F.struct(F.lit(i).alias("item"), F.coalesce(f"q_{i}", f"p_{i}", f"r_{i}").alias("value")) for i in items])
    return rows.select("project", F.inline(told)).select("item", "project", "value")
