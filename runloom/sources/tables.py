"""Counts files, sample sheets, metadata, project tables, versions and lengths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _null(x: Column) -> Column:
    """`.` and `None` stand for nothing, as an empty text does."""
    return F.when(~x.isin(".", "None", ""), x)


def parse_counts(lines: DataFrame) -> DataFrame:
    """value (a line) -> lane, barcode, n, error. Four columns, or three without a
    lane; comments are left out; a lane that is no number is null."""
    f = F.split("value", "\t")
    four = F.size(f) == 4
    rows = lines.filter(~F.col("value").startswith("#") & (F.trim("value") != "")).select("value", f.alias("f"), four.alias("four"))
    cell = lambda i: F.get("f", F.lit(i))
    n = F.when(F.col("four"), cell(3)).otherwise(cell(2)).try_cast("long")
    known = F.size("f").isin(3, 4) & n.isNotNull()
    return rows.select(
        F.when(F.col("four"), cell(0).try_cast("int")).alias("lane"),
        F.replace(F.when(F.col("four"), cell(2)).otherwise(cell(1)), F.lit("-"), F.lit("+")).alias("barcode"), n.alias("n"),
        F.when(~known, F.col("value")).alias("error"),
    )


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    return parse_counts(spark.read.text(path))


def counts_lines(ranked: DataFrame) -> DataFrame:
    """lane, rank, barcode, n as tab-separated lines. A null lane is kept, empty."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("lane", "rank", "barcode", "n")]
    return ranked.select(F.concat_ws("\t", *cells).alias("value"))


def parse_sheet(rows: DataFrame) -> DataFrame:
    """Lane, Sample_ID, Sample_Name, Sample_Project, index, index2 -> lane, sample,
    project, index_seq (`+` between two, for `-` too; '' for none)."""
    have = set(rows.columns)
    given = lambda c: F.nullif(F.trim(F.col(c)), F.lit("")) if c in have else F.lit(None).cast("string")
    extra = ["line_no"] if "line_no" in have else []
    name = [given("Sample_Name").alias("sample_name")] if "Sample_Name" in have else []
    return rows.select(
        given("Lane").try_cast("int").alias("lane"), given("Sample_ID").alias("sample"), *name, given("Sample_Project").alias("project"),
        F.replace(F.concat_ws("+", given("index"), given("index2")), F.lit("-"), F.lit("+")).alias("index_seq"), *extra,
    )


#: Columns of a sheet's data that are read.
SHEET_COLUMNS = ("Lane", "Sample_ID", "Sample_Name", "Sample_Project", "index", "index2")


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """The rows below `[Data]`; all of the file if it has no sections. Cells may be
    quoted. The header names the cells; nothing is read before the plan is run."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("line_no", "v"))
    in_data = F.max(F.when(F.lower("v").startswith("[data]"), F.col("line_no")))
    start = lines.agg(F.coalesce(in_data, F.lit(-1)).alias("start"))
    rows = lines.join(F.broadcast(start), F.col("line_no") > F.col("start")).filter(F.trim(F.replace("v", F.lit(","))) != "")
    head = rows.agg(F.min("line_no").alias("head_no"), csv_cells(F.min_by("v", "line_no")).alias("names"))  # one row
    data = rows.join(F.broadcast(head), F.col("line_no") > F.col("head_no")).withColumn("cells", csv_cells(F.col("v")))
    cell = lambda name: F.get("cells", F.array_position("names", name).cast("int") - 1)
    found = parse_sheet(data.select("line_no", *[F.when(F.array_contains("names", n), cell(n)).alias(n) for n in SHEET_COLUMNS]))
    # Without an ID the name stands for the sample.
    return found.withColumn("sample", F.coalesce("sample", "sample_name")).drop("sample_name")


def csv_cells(line: Column) -> Column:
    """The cells of a line with commas between, of which some are quoted; a quote in
    a quoted cell is doubled."""
    found = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(r',("(?:[^"]|"")*"|[^,]*)'), F.lit(1))
    bare = lambda x: F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))
    return F.transform(found, lambda x: F.when(x.startswith('"'), bare(x)).otherwise(x))


def file_lines(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """file, line_no, value: the lines of all files below a folder."""
    texts = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").text(path, wholetext=True)
    return texts.select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.split("value", "\r?\n")).alias("line_no", "value"))


def read_metadata(spark: SparkSession, path: str, keys, pattern: str = "*") -> DataFrame:
    """Key and value files below a folder; the entity is the file's path."""
    return parse_metadata(file_lines(spark, path, pattern).withColumnRenamed("file", "entity"), keys)


#: The columns that a project table has at least.
PROJECT_COLUMNS = ("Project", "Samples", "User", "Library", "SC_Platform", "Organism", "PI", "Comments")


def read_projects(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """file, project, disabled and the other default columns of project tables. The
    first line names the columns; those it lacks are null."""
    lines = file_lines(spark, path, pattern).filter(F.trim("value") != "").withColumn("cells", F.split("value", "\t"))
    heads = lines.groupBy("file").agg(F.min("line_no").alias("head_no"), F.min_by(F.split(F.ltrim("value", F.lit("#")), "\t"), "line_no").alias("names"))
    data = lines.join(heads, "file").filter("line_no > head_no")
    cell = lambda n: F.when(F.array_contains("names", n), F.get("cells", F.array_position("names", n).cast("int") - 1))
    named = data.select("file", *[cell(n).alias("project" if n == "Project" else n) for n in PROJECT_COLUMNS])
    return parse_projects(named)


def write_projects(projects: DataFrame, path: str) -> None:
    """project, disabled and other columns to one text file: a table of projects has a
    line for each, hundreds at most."""
    head = "#" + "\t".join(["Project", *[c for c in projects.columns if c not in ("project", "disabled")]])
    rows = F.array_sort(F.collect_list(F.struct("project", "value")))
    lines = F.concat(F.array(F.lit(head)), F.transform(rows, lambda x: x["value"]))
    _project_lines(projects).agg(F.array_join(lines, "\n").alias("value")).write.text(path)


def parse_metadata(lines: DataFrame, keys) -> DataFrame:
    """entity, value (`key<TAB>value` lines) -> a row for each entity: the declared
    keys, and a map of all others."""
    key, value = F.split_part("value", F.lit("\t"), F.lit(1)), F.split_part("value", F.lit("\t"), F.lit(2))
    told = F.when(value.isin("Y", "True"), "true").when(value.isin("N", "False"), "false").otherwise(_null(value))
    rows = lines.filter(F.contains("value", F.lit("\t"))).select("entity", key.alias("k"), told.alias("v"))
    known = [F.max(F.when(F.col("k") == k, F.col("v"))).alias(k) for k in keys]
    others = F.collect_list(F.when(~F.col("k").isin(list(keys)), F.struct("k", "v")))
    return rows.groupBy("entity").agg(*known, F.map_from_entries(others).alias("others"))


def metadata_lines(table: DataFrame, keys) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(k).alias("k"), F.coalesce(F.col(k).cast("string"), F.lit(".")).alias("v")) for k in keys])
    return table.select("entity", F.inline(pairs)).select("entity", F.concat_ws("\t", "k", "v").alias("value"))


def parse_projects(rows: DataFrame) -> DataFrame:
    """Projects of a table: `#` before a name disables it, `.` is null."""
    name = F.col("project")
    return rows.select(
        F.ltrim(name, F.lit("#")).alias("project"), name.startswith("#").alias("disabled"),
        *[_null(F.trim(F.col(c))).alias(c) for c in rows.columns if c != "project"],
    )


def project_rows(projects: DataFrame) -> DataFrame:
    """The table's rows as written, ordered by name without `#`."""
    return _project_lines(projects).orderBy("project").select("value")


def _project_lines(projects: DataFrame) -> DataFrame:
    name = F.when(F.col("disabled"), F.concat(F.lit("#"), "project")).otherwise(F.col("project"))
    cells = [F.coalesce(F.col(c).cast("string"), F.lit(".")) for c in projects.columns if c not in ("project", "disabled")]
    return projects.select("project", F.concat_ws("\t", name, *cells).alias("value"))


def read_versions(spark: SparkSession, path: str, pattern: str = "_versions", wanted=None) -> DataFrame:
    return parse_versions(file_lines(spark, path, pattern), wanted)


def parse_versions(lines: DataFrame, wanted=None) -> DataFrame:
    """`package<TAB>version` lines -> package, versions, sorted. `wanted`: packages
    that get a row, if without versions; without a list, all that are found."""
    found = _parsed_versions(lines)
    if wanted is None:
        return found
    asked = lines.sparkSession.createDataFrame([(x,) for x in wanted], "package string")
    return asked.join(found, "package", "left").withColumn("versions", F.coalesce("versions", F.array().cast("array<string>")))


def _parsed_versions(lines: DataFrame) -> DataFrame:
    f = F.split(F.trim("value"), "\t")
    rows = lines.filter(F.size(f) == 2).select(F.get(f, F.lit(0)).alias("package"), F.get(f, F.lit(1)).alias("version"))
    return rows.groupBy("package").agg(F.array_sort(F.collect_set("version")).alias("versions"))


DISTRIBUTIONS = ("seq_lengths_dist", "seq_lengths_masked_dist", "seq_lengths_padded_dist")
LENGTHS = (
    "fastq string, nreads bigint, nreads_masked bigint, nreads_padded bigint, frac_reads_masked double, frac_reads_padded double, "
    "min_length int, max_length int, mean_length double, median_length int, " + ", ".join(f"{d} map<string,bigint>" for d in DISTRIBUTIONS)
)


def read_lengths(spark: SparkSession, path: str, pattern: str = "*.json", lines: bool = False) -> DataFrame:
    """A record for each file below a folder, or, with `lines`, for each line."""
    texts = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").text(path, wholetext=not lines)
    return parse_lengths(texts)


def parse_lengths(records: DataFrame) -> DataFrame:
    """JSON texts of length statistics; the maps' keys become numbers again."""
    parsed = records.select(F.from_json("value", LENGTHS).alias("r")).select("r.*")
    return parsed.withColumns({d: F.transform_keys(d, lambda k, v: k.cast("int")) for d in DISTRIBUTIONS})


def lengths_json(stats: DataFrame) -> DataFrame:
    return stats.select(F.to_json(F.struct(*[F.col(c) for c in stats.columns])).alias("value"))


def newer_than(inventory: DataFrame, done: DataFrame) -> DataFrame:
    """Files that are new, or changed since they were landed."""
    latest = done.groupBy("path").agg(F.max("modified").alias("_landed"))
    return inventory.join(latest, "path", "left").filter("_landed IS NULL OR modified > _landed").drop("_landed")


def sheet_numbers(sheet: DataFrame) -> DataFrame:
    """Sample numbers by first appearance in the sheet."""
    first = sheet.groupBy("sample").agg(F.min("line_no").alias("line_no"))
    return first.withColumn("sample_number", F.row_number().over(Window.orderBy("line_no", "sample"))).drop("line_no")
