"""Outputs of quality tools, read in bulk: one row (file, text) for each output.

All parsers split a text into an array of lines and go on with column expressions
inside the row, so that any number of files is parsed in one scan, without a shuffle:
sections, header rows and versions belong to a file, and a file is a row. A null text
has no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import small_files

#: Tasks for each core, beyond which a task takes several of Spark's partitions, and how many at most.
TASKS_A_CORE, PARTITIONS_A_TASK = 16, 32
#: Ends of patterns whose files are not compressed.
PLAIN = (".txt", ".csv", ".tsv", ".html", ".json", ".log")


def read_texts(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """file, text for each file. Spark's text reader, which knows compressed files, copies
    the session's whole configuration for each file, under a lock that all tasks of an
    executor share; files whose pattern says that they are plain are read as bytes, in
    mounted folders by the tasks themselves.

    Spark makes a partition of 32 small files; a task costs more than that, above all its
    part in every shuffle behind. So a task takes up to 1,024 of them (32,768 that it
    opens itself), or 4 GB of larger ones, once all cores have enough to do."""
    cores = spark.sparkContext.defaultParallelism
    folder = small_files.folder_of(spark, path, pattern) if pattern.endswith(PLAIN) else None
    if folder is not None:
        files = small_files.listed(spark, folder, pattern)
        n = _partitions(spark, files)
        return small_files.read(files, max(1, min(n, max(TASKS_A_CORE * cores, -(-n // PARTITIONS_A_TASK)))))
    reader = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    if pattern.endswith(PLAIN):
        found, text = reader.format("binaryFile").load(path), F.col("content").cast("string")
    else:
        found, text = reader.text(path, wholetext=True), F.col("value")
    found = found.select(F.col("_metadata.file_path").alias("file"), text.alias("text"))
    n = found.rdd.getNumPartitions()
    tasks = max(TASKS_A_CORE * cores, -(-n // PARTITIONS_A_TASK))
    return found.coalesce(tasks) if n > tasks else found


def _partitions(spark: SparkSession, files: DataFrame) -> int:
    """As many as Spark would make of so many files, each of which costs its bytes and
    those for which one could be opened: fewer here than Spark takes (4 MB)."""
    most, opening = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes(), small_files.OPENING
    n, size = files.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    total = size + n * opening
    most = min(most, max(opening, total // spark.sparkContext.defaultParallelism))
    return min(n, -(-total // max(1, most)))


def read(spark: SparkSession, path: str, parser, pattern: str = "*") -> DataFrame:
    """The outputs below a folder by one of the parsers here, as `read(spark, folder,
    screen, "*_screen.txt")`. All files are parsed in one scan."""
    return parser(read_texts(spark, path, pattern))


def _lines() -> Column:
    return F.split("text", "\r?\n")


def lines_of(texts: DataFrame) -> DataFrame:
    return texts.select("file", F.posexplode(_lines()).alias("line_no", "line"))


def sections(texts: DataFrame, mark: Callable[[Column], Column]) -> DataFrame:
    """file, mark, first, body: what stands between lines that `mark` gives a value,
    with that of the line before it; null for what comes before the first. `body` is
    an array of (line_no, line); `first` tells a mark's first section of the file."""
    numbered = F.transform(_lines(), lambda x, i: F.struct(i.alias("line_no"), x.alias("line")))
    marks = F.transform("_lines", lambda x: F.struct(x["line_no"].alias("at"), mark(x["line"]).alias("mark")))
    top = F.array(F.struct(F.lit(-1).alias("at"), F.lit(None).cast("string").alias("mark")))
    rows = texts.select("file", numbered.alias("_lines")).filter("_lines IS NOT NULL")
    rows = rows.withColumn("_marks", F.concat(top, F.filter(marks, lambda m: m["mark"].isNotNull())))
    rows = rows.select("file", "_lines", "_marks", F.posexplode("_marks").alias("_k", "_section"))
    at, name = F.col("_section.at"), F.col("_section.mark")
    end = F.coalesce(F.get("_marks", F.col("_k") + 1)["at"], F.size("_lines"))
    first = F.array_position(F.col("_marks.mark"), name) == F.col("_k") + 1
    return rows.select("file", name.alias("mark"), first.alias("first"), F.slice("_lines", at + 2, end - at - 1).alias("body"))


def number(s: Column) -> Column:
    """Thousands commas, quotes and percent signs are left out."""
    return F.regexp_replace(s, r'[",%\s]', "").try_cast("double")


def fastqc_modules(texts: DataFrame) -> DataFrame:
    """file, module, status, line_no, cols: the rows of all modules; header rows
    start with `#`."""
    marker = lambda line: F.when(line.startswith(">>") & (line != ">>END_MODULE"), line)
    rows = sections(texts, marker).filter("mark IS NOT NULL").select("file", F.col("mark").alias("_m"), F.inline("body"))
    inside = rows.filter(~F.col("line").startswith(">>") & ~F.col("line").startswith("##") & (F.col("line") != ""))
    name = F.split(F.substring(F.col("_m"), F.lit(3), F.length("_m")), "\t")
    return inside.select("file", F.get(name, F.lit(0)).alias("module"), F.get(name, F.lit(1)).alias("status"), "line_no", F.split("line", "\t").alias("cols"))


def fastqc_summary(texts: DataFrame) -> DataFrame:
    f = F.split("line", "\t")
    return lines_of(texts).filter(F.size(f) == 3).select("file", F.get(f, F.lit(0)).alias("status"), F.get(f, F.lit(1)).alias("module"), F.get(f, F.lit(2)).alias("name"))


def modules_by_status(summary: DataFrame) -> DataFrame:
    return summary.groupBy("file", "status").agg(F.array_sort(F.collect_list("module")).alias("modules"))


def base_quality(modules: DataFrame) -> DataFrame:
    """Per-base quality from the tool's own table, cut to whole numbers."""
    rows = modules.filter((F.col("module") == "Per base sequence quality") & ~F.get("cols", F.lit(0)).startswith("#"))
    cell = lambda i: F.get("cols", F.lit(i)).try_cast("double").cast("int")
    names = ("mean", "median", "q25", "q75", "p10", "p90")
    return rows.select("file", F.get("cols", F.lit(0)).alias("base"), *[cell(i + 1).alias(n) for i, n in enumerate(names)])


def adapter_content(modules: DataFrame) -> DataFrame:
    """file, adapter, content: the sum over positions by their number times 100."""
    rows = modules.filter(F.col("module") == "Adapter Content")
    heads = rows.filter(F.get("cols", F.lit(0)).startswith("#")).groupBy("file").agg(F.min_by("cols", "line_no").alias("names"))
    data = rows.filter(~F.get("cols", F.lit(0)).startswith("#")).join(heads, "file").select("file", F.posexplode("cols").alias("i", "v"), "names")
    cells = data.filter("i > 0").select("file", F.get("names", F.col("i")).alias("adapter"), F.col("v").try_cast("double").alias("v"))
    return cells.groupBy("file", "adapter").agg((F.sum("v") / (F.count("*") * 100)).alias("content"))


def deduplicated(modules: DataFrame) -> DataFrame:
    """Percentage left after deduplication: pass from 30, warn from 20."""
    found = modules.filter((F.col("module") == "Sequence Duplication Levels") & (F.get("cols", F.lit(0)) == "#Total Deduplicated Percentage"))
    p = F.get("cols", F.lit(1)).try_cast("double")
    return found.select("file", p.alias("percent"), F.when(p < 20, "fail").when(p < 30, "warn").otherwise("pass").alias("verdict"))


def screen(texts: DataFrame) -> DataFrame:
    """file, library, metric, value of both dialects; the trailing line gives a row
    without a library."""
    is_head = lambda line: line.startswith("Library\t") | line.startswith("Genome\t")
    kept = F.filter(_lines(), lambda x: (x != "") & ~x.startswith("#"))
    rows = texts.select("file", kept.alias("_l"))
    head = F.get(F.filter("_l", is_head), F.lit(0))
    rows = rows.select("file", F.split(head, "\t").alias("names"), F.explode("_l").alias("line")).filter(~is_head(F.col("line")))
    rows = rows.withColumn("c", F.split("line", "\t"))
    cell = lambda library, metric, v: F.struct(library.alias("library"), metric.alias("metric"), v.alias("v"))
    none = F.array(cell(F.lit(None).cast("string"), F.lit("Hit_no_libraries"), F.split_part("line", F.lit(":"), F.lit(2))))
    values = F.slice("c", F.lit(2), F.size("c"))
    data = F.transform(values, lambda v, i: cell(F.get("c", F.lit(0)), F.ltrim(F.get("names", i + 1), F.lit("%")), v))
    cells = F.when(F.col("line").startswith("%Hit_no"), none).when(F.col("names").isNotNull(), data)
    return rows.select("file", F.inline(cells)).select("file", "library", "metric", number(F.col("v")).alias("value"))


def screen_classes(found: DataFrame) -> DataFrame:
    """Mapped percentage of each library: the four hit columns together."""
    hits = found.filter(F.col("metric").rlike("^(One|Multiple)_hits?_(one|multiple)_(library|genome|libraries|genomes)$"))
    total = F.sum("value")
    return hits.groupBy("file", "library").agg(total.alias("mapped")).withColumn(
        "class", F.when(F.col("mapped") > 2.0, "major").when(F.col("mapped") > 0.25, "minor")
    )


def strand(texts: DataFrame) -> DataFrame:
    """file, version, genome, forward, reverse, ratio, label"""
    from ..functions.names import strand_label

    versions = F.transform(_lines(), lambda x: F.nullif(F.regexp_extract(x, r"version:?\s*([0-9][^\s]*)", 1), F.lit("")))
    rows = texts.select("file", F.array_max(versions).alias("version"), F.explode(_lines()).alias("line"))
    f = F.split("line", "\t")
    data = rows.filter(~F.col("line").startswith("#") & (F.size(f) >= 3)).select(
        "file", "version", F.get(f, F.lit(0)).alias("genome"), number(F.get(f, F.lit(1))).alias("forward"), number(F.get(f, F.lit(2))).alias("reverse")
    )
    return data.withColumns({"ratio": F.try_divide("forward", "reverse"), "label": strand_label(F.col("forward"), F.col("reverse"))})


def insert_sizes(texts: DataFrame) -> DataFrame:
    """file, kind (`metric` or `histogram`), name, value of the two sections; a second
    section of a kind is left out."""
    mark = lambda line: F.when(line.startswith("## METRICS"), "metric").when(line.startswith("## HISTOGRAM"), "histogram")
    plain = F.filter(F.transform("body", lambda x: F.split(x["line"], "\t")), lambda c: ~F.get(c, F.lit(0)).startswith("#") & (F.array_join(c, "\t") != ""))
    rows = sections(texts, mark).filter("mark IS NOT NULL AND first").select("file", F.col("mark").alias("kind"), plain.alias("_c"))
    row = lambda i: F.get("_c", F.lit(i))
    cell = lambda name, v: F.struct(name.alias("name"), v.alias("v"))
    metric = F.transform(row(0), lambda name, i: cell(name, F.get(row(1), i)))
    histogram = F.transform(F.slice("_c", F.lit(2), F.size("_c")), lambda c: cell(F.get(c, F.lit(0)), F.get(c, F.lit(1))))
    cells = F.when(F.col("kind") == "histogram", histogram).when(F.size("_c") > 1, metric)
    return rows.select("file", "kind", F.inline(cells)).select("file", "kind", "name", number(F.col("v")).alias("value"))


def collated_insert_sizes(found: DataFrame) -> DataFrame:
    """Four metrics of each file, in columns, ordered by file."""
    names = ("MEAN_INSERT_SIZE", "STANDARD_DEVIATION", "MEDIAN_INSERT_SIZE", "MEDIAN_ABSOLUTE_DEVIATION")
    cells = [F.max(F.when(F.col("name") == n, F.col("value"))).alias(n.lower()) for n in names]
    return found.filter("kind = 'metric'").groupBy("file").agg(*cells).orderBy("file")


def rnaseq(texts: DataFrame) -> DataFrame:
    """file, section, item, count, percent of `name = 1,234 (5.6%)` lines."""
    head = lambda line: F.nullif(F.regexp_extract(line, r"^>>>>>>>\s*(.*)$", 1), F.lit(""))
    rows = sections(texts, head).select("file", F.col("mark").alias("section"), F.inline("body")).filter(F.contains("line", F.lit(" = ")))
    form = r"^\s*(.+?) = ([^(]*?)\s*(?:\(([0-9.]+)%\))?$"
    return rows.select(
        "file", "section", F.regexp_extract("line", form, 1).alias("item"), F.regexp_extract("line", form, 2).alias("value_text"),
        number(F.regexp_extract("line", form, 2)).alias("count"), F.regexp_extract("line", form, 3).try_cast("double").alias("percent"),
    )


def coverage_profile(texts: DataFrame) -> DataFrame:
    """file, x, y; x is cut to a whole number, and a later line wins."""
    f = F.split("line", "\t")
    rows = lines_of(texts).filter(~F.col("line").startswith("#") & (F.size(f) == 2))
    return rows.groupBy("file", F.get(f, F.lit(0)).try_cast("double").cast("int").alias("x")).agg(F.max_by(F.get(f, F.lit(1)).try_cast("double"), "line_no").alias("y"))


def strand_inference(texts: DataFrame) -> DataFrame:
    """file, paired, forward, reverse, undetermined"""
    lines = F.col("_l")
    value = lambda form: F.array_max(F.transform(lines, lambda x: F.regexp_extract(x, form, 1).try_cast("double")))
    return texts.select("file", _lines().alias("_l")).filter(lines.isNotNull()).select(
        "file",
        F.exists(lines, lambda x: F.contains(x, F.lit("This is PairEnd Data"))).alias("paired"),
        value(r'^Fraction of reads explained by "(?:1\+\+,1--,2\+-,2-\+|\+\+,--)":\s*([0-9.]+)').alias("forward"),
        value(r'^Fraction of reads explained by "(?:1\+-,1-\+,2\+\+,2--|\+-,-\+)":\s*([0-9.]+)').alias("reverse"),
        value(r"^Fraction of reads failed to determine:\s*([0-9.]+)").alias("undetermined"),
    )


def _cells(line: Column) -> Column:
    """A line of comma-separated cells, of which some are quoted."""
    found = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(r',("[^"]*"|[^,]*)'), F.lit(1))
    return F.transform(found, lambda x: F.btrim(x, F.lit('"')))


def cell_summary(texts: DataFrame) -> DataFrame:
    """One-row summaries with any header -> file, metric, value."""
    kept = texts.select("file", F.filter(_lines(), lambda x: x != "").alias("_l"))
    rows = kept.select("file", F.get("_l", F.lit(0)).alias("head"), F.get("_l", F.size("_l") - 1).alias("data"))
    zipped = F.arrays_zip(_cells(F.col("head")).alias("metric"), _cells(F.col("data")).alias("v"))
    return rows.select("file", F.inline(zipped)).toDF("file", "metric", "v").withColumn("value", number(F.col("v")))


def library_summary(texts: DataFrame) -> DataFrame:
    """Summaries that are long already: six columns."""
    c = _cells(F.col("line"))
    rows = lines_of(texts).filter((F.col("line_no") > 0) & (F.col("line") != ""))
    names = ("scope", "library_type", "grouped_by", "group_name", "metric", "v")
    return rows.select("file", "line_no", *[F.get(c, F.lit(i)).alias(n) for i, n in enumerate(names)]).withColumn("value", number(F.col("v")))


def metric_by_type(found: DataFrame, metric: str, library_type: str = "Gene Expression") -> DataFrame:
    """The first hit of a metric in each file."""
    hits = found.filter((F.col("metric") == metric) & (F.col("library_type") == library_type))
    return hits.groupBy("file").agg(F.min_by("value", "line_no").alias("value"))
