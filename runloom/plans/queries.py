"""One query for each operator over the fixture views, with the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import barcodes as B
from ..functions import names as N
from ..operators import barcodes as C
from ..operators import grouping as G
from ..operators import lengths as L
from ..operators import pairing as P
from ..operators import reads as D
from ..operators import registry as R
from ..operators import stats as S
from ..sources import fastq, qc, shared, tables, text_sink
from ..streaming import incremental
from .fixtures import view, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
UNIT = ("project", "sample", "lane")
LANES = (1, 2, 3, 4)
#: A lane's file of read 1.
FILE_SQL = "project || '_' || sample || '_' || CAST(lane AS STRING)"


def _file():
    return F.concat_ws("_", "project", "sample", F.col("lane").cast("string"))


def query(*views: str, sql: str | None = None, ints: str = "", longs: str = ""):
    """Registers a function of the views' DataFrames under its name. `ints` and
    `longs` name columns that the SQL has to cast to Spark's types."""

    def put(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(*[view(spark, sf_dir, v) for v in views])
        if sql is not None:
            casts = [f'CAST("{c}" AS INT) AS "{c}"' for c in ints.split()] + [f'CAST("{c}" AS BIGINT) AS "{c}"' for c in longs.split()]
            text = with_views(views, sql)
            ORACLES[f.__name__] = f"SELECT * REPLACE ({', '.join(casts)}) FROM ({text}) typed" if casts else text
        return f

    return put


# Reads, lanes, files -------------------------------------------------------------


@query("reads", sql="""
SELECT lane, count(*) AS total_reads, count(*) FILTER (project <> 'Undetermined_indices') AS assigned_reads,
 count(*) FILTER (project = 'Undetermined_indices') AS unassigned_reads,
 round(count(*) FILTER (project <> 'Undetermined_indices') * 100.0 / count(*), 2) AS percent_assigned,
 round(count(*) FILTER (project = 'Undetermined_indices') * 100.0 / count(*), 2) AS percent_unassigned FROM reads GROUP BY lane""")
def a08_lane_summary(reads):
    return S.lane_summary(reads)


@query("reads", sql=f"SELECT {FILE_SQL} AS file, count(*) AS n_reads FROM reads GROUP BY ROLLUP ({FILE_SQL})")
def a03_reads_per_file(reads):
    return S.reads_per_file(reads.withColumn("file", _file()))


@query("reads", sql=f"SELECT project, sample, {FILE_SQL} AS file, CASE WHEN project = 'P1' THEN 9 ELSE lane END AS lane, count(*) AS n_reads FROM reads GROUP BY ALL", ints="lane")
def a04_reads_per_lane(reads):
    """The names of P1's files have a lane; the others' lanes are those of the headers."""
    return S.reads_per_lane(reads.withColumn("file", _file()), F.when(F.col("project") == "P1", 9))


PIVOT = ", ".join(f"sum(n) FILTER (lane = {n}) AS \"L{n}\"" for n in LANES)


@query("reads", sql=f"SELECT project, sample, project || '_' || sample AS file, sum(n) AS n_reads, {PIVOT} FROM (SELECT project, sample, lane, count(*) AS n FROM reads GROUP BY ALL) t GROUP BY project, sample", longs="n_reads L1 L2 L3 L4")
def a05_lane_pivot(reads):
    return S.full_stats(S.reads_per_lane(reads.withColumn("file", F.concat_ws("_", "project", "sample"))), LANES)


@query("reads", sql="SELECT project, sample, project || '_' || sample AS file, count(*) AS n_reads FROM reads GROUP BY project, sample")
def a06_basic_stats(reads):
    return S.full_stats(S.reads_per_lane(reads.withColumn("file", F.concat_ws("_", "project", "sample"))), LANES).select("project", "sample", "file", "n_reads")


LANE_SAMPLE = "SELECT lane, project, sample, count(*) AS n_reads FROM reads GROUP BY ALL"


@query("reads", sql=f"SELECT *, sum(n_reads) OVER (PARTITION BY lane) AS total_reads, round(n_reads * 100.0 / sum(n_reads) OVER (PARTITION BY lane), 1) AS percent FROM ({LANE_SAMPLE}) t", longs="total_reads")
def a07_lane_sample(reads):
    return S.lane_samples(reads)


@query("reads", "sample_sheet", sql=f"SELECT lane, project, sample, n_reads, row_number() OVER (ORDER BY lane, project, sample) AS place FROM ({LANE_SAMPLE}) t", longs="place")
def t03_report_order(reads, sheet):
    """Places as of the rows in the order in which they come."""
    return shared.with_places(S.lane_samples_report(reads).select("lane", "project", "sample", "n_reads"), "place")


@query("reads", "sample_sheet", sql=f"""
WITH f AS ({LANE_SAMPLE}), a AS (SELECT * FROM f UNION ALL
 SELECT DISTINCT lane, project, sample, 0 FROM sample_sheet s WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.lane = s.lane AND f.project = s.project AND f.sample = s.sample))
SELECT *, sum(n_reads) OVER (PARTITION BY lane) AS total_reads, round(n_reads * 100.0 / sum(n_reads) OVER (PARTITION BY lane), 1) AS percent FROM a""", longs="total_reads")
def j10_expected_zero_rows(reads, sheet):
    return S.lane_samples(reads, sheet)


@query("fastq_files", sql="SELECT * FROM fastq_files WHERE read_number = 1 AND NOT is_index")
def p01_first_reads(files):
    return S.first_reads(files)


@query("fastq_files", sql="SELECT fastq, CASE WHEN read_number = 1 THEN lane END AS lane FROM fastq_files WHERE read_number <> 1 OR lane IN (1, 3)")
def p02_lane_subset(files):
    named = files.withColumn("lane", F.when(F.col("read_number") == 1, F.col("lane")))
    return S.in_lanes(named, (1, 3)).select("fastq", "lane")


@query("fastq_files", sql="SELECT fastq FROM fastq_files WHERE sample IN ('S1', 'S2') AND regexp_matches(fastq, '^.*_R1_.*[.]gz$')")
def p05_sample_and_glob(files):
    return files.filter(F.col("sample").isin("S1", "S2") & N.glob_like(F.col("fastq"), "*_R1_*.gz")).select("fastq")


@query("fastq_files", sql="SELECT fastq FROM fastq_files WHERE regexp_matches(fastq, '^S[^12].*_R1_.*[.]gz$')")
def p05_negated_glob(files):
    return files.filter(N.glob_like(F.col("fastq"), "S[!12]*_R1_*.gz")).select("fastq")


@query("fastq_files", sql="SELECT DISTINCT fastq FROM fastq_files WHERE (NOT is_index AND read_number = 2) OR is_index")
def p06_read_selectors(files):
    return P.select_files(files, ("r2", "i*"))


@query("fastq_files", sql="SELECT fastq, read_number FROM fastq_files WHERE NOT is_index")
def p07_no_index_files(files):
    return S.biological(files).select("fastq", "read_number")


@query("reads", "fastq_files", sql="""
SELECT f.fastq, f.read_number, CAST(r.lane AS INT) AS lane, r.n_reads FROM fastq_files f JOIN
 (SELECT project, sample, lane, count(*) AS n_reads FROM reads GROUP BY ALL) r ON r.project = f.project AND r.sample = f.sample AND r.lane = f.lane
WHERE f.read_number > 1 AND NOT f.is_index""")
def j08_inherit_counts(reads, files):
    named = files.filter("read_number = 1 AND NOT is_index").select(*UNIT, "fastq")
    per = reads.groupBy(*UNIT).agg(F.count("*").alias("n_reads")).join(named, list(UNIT))
    others = files.filter("read_number > 1 AND NOT is_index").select("project", "fastq", "read_number")
    found = S.inherit_counts(
        others, per.select(F.col("project").alias("p"), "lane", "n_reads", "fastq").withColumnRenamed("fastq", "file"),
        F.concat_ws("/", "project", P.stem(F.col("fastq"))), F.concat_ws("/", "p", P.stem(F.col("file"))),
    )
    return found.select("fastq", "read_number", "lane", "n_reads")


def _lane_columns(reads, lanes):
    """Full statistics of some lanes' reads: a column for each lane."""
    part = reads.filter(F.col("lane").isin(list(lanes))).groupBy(*UNIT).agg(F.count("*").alias("n_reads")).withColumn("file", F.concat_ws("_", "project", "sample"))
    return S.full_stats(part, lanes).drop("file")


LANE_COLUMNS = lambda lanes: "SELECT project, sample, sum(n) AS n_reads, " + ", ".join(f'sum(n) FILTER (lane = {k}) AS "L{k}"' for k in lanes) + f" FROM (SELECT project, sample, lane, count(*) AS n FROM reads WHERE lane IN {lanes} GROUP BY ALL) t GROUP BY project, sample"


@query("reads", sql=f"""
WITH o AS ({LANE_COLUMNS((1, 2, 3))}), n AS ({LANE_COLUMNS((3, 4))})
SELECT coalesce(n.project, o.project) AS project, coalesce(n.sample, o.sample) AS sample, coalesce(n.n_reads, o.n_reads) AS n_reads,
 CASE WHEN n.project IS NULL THEN o."L1" END AS "L1", CASE WHEN n.project IS NULL THEN o."L2" END AS "L2", CASE WHEN n.project IS NULL THEN o."L3" ELSE n."L3" END AS "L3", n."L4"
FROM o FULL JOIN n ON o.project = n.project AND o.sample = n.sample""", longs="n_reads L1 L2 L3 L4")
def j09_stats_upsert(reads):
    return S.upsert(_lane_columns(reads, (1, 2, 3)), _lane_columns(reads, (3, 4)), ("project", "sample"))


@query("reads", "sample_sheet", sql=f"""
WITH f AS ({LANE_SAMPLE}), a AS (SELECT lane, n_reads FROM f UNION ALL
 SELECT lane, 0 FROM sample_sheet s WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.lane = s.lane AND f.project = s.project AND f.sample = s.sample)),
l AS (SELECT unnest([1, 2, 3, 4, 5]) AS lane)
SELECT CAST(l.lane AS INT) AS lane, max(a.n_reads) IS NULL AS no_samples, coalesce(min(a.n_reads) = 0, FALSE) AS empty_sample FROM l LEFT JOIN a ON a.lane = l.lane GROUP BY l.lane""")
def a36_lane_warnings(reads, sheet):
    lanes = sheet.select("lane").union(sheet.agg((F.max("lane") + 1).alias("lane")))
    return S.warnings(S.lane_samples(reads, sheet), lanes)


@query("reads", sql=f"""
WITH f AS (SELECT project, sample, project || '_' || sample AS file, lane, count(*) FILTER (l_orderkey % 3 > 0) AS n FROM reads WHERE lane > 1 OR project <> 'P1' GROUP BY ALL),
e AS (SELECT * FROM f UNION ALL SELECT DISTINCT project, sample, file, 9, 0 FROM f WHERE project = 'P2')
SELECT project, sample, file, coalesce(list_sort(list(lane) FILTER (n = 0)), []) AS empty_lanes, min(n) = 0 AS warning FROM e GROUP BY project, sample, file""")
def a36_file_warnings(reads):
    """Files of P2 should have reads of lane 9; reads of every third order are lost."""
    named = reads.filter("lane > 1 OR project <> 'P1'").withColumn("file", F.concat_ws("_", "project", "sample"))
    expected = named.select("project", "sample", "file", "lane").distinct()
    more = expected.filter("project = 'P2'").withColumn("lane", F.lit(9))
    return S.file_warnings(expected.unionByName(more), S.reads_per_lane(named.filter("l_orderkey % 3 > 0")))


@query("reads", sql=f"""SELECT lane, project, sample, CASE WHEN lag(project) OVER (PARTITION BY lane ORDER BY project, sample) = project THEN '' ELSE project END AS shown_project
FROM ({LANE_SAMPLE}) t""")
def w08_blank_repeats(reads):
    return S.blank_repeats(S.lane_samples(reads)).select("lane", "project", "sample", "shown_project")


@query("fastq_files", "registry", sql="""SELECT pi, f.project, CAST(sum(size_bytes) AS BIGINT) AS bytes, CAST(grouping(pi) * 2 + grouping(f.project) AS BIGINT) AS level
FROM fastq_files f JOIN registry r ON r.project = f.project GROUP BY ROLLUP (pi, f.project)""")
def a22_usage_rollup(files, registry):
    return S.disk_usage(files.join(registry.select("project", "pi"), "project")).withColumn("bytes", F.col("bytes").cast("long"))


@query("reads", sql="SELECT DISTINCT lane, project, sample FROM reads")
def u06_distinct(reads):
    return reads.select("lane", "project", "sample").distinct()


@query("reads", sql="SELECT project, sample, count(*) AS n_reads, min(length(sequence)) AS least FROM reads GROUP BY project, sample", ints="least")
def u02_merged_lanes(reads):
    whole = D.concatenated(reads)
    return whole.groupBy("project", "sample").agg(F.count("*").alias("n_reads"), F.min(F.length("sequence")).alias("least"))


@query("reads", sql="SELECT lane, count(*) AS n, count(DISTINCT barcode) AS n_barcodes FROM reads GROUP BY lane")
def u03_split_by_lane(reads):
    path = shared.new_folder(reads.sparkSession, "lanes")
    fastq.write_split(reads, path, ["lane"])
    return reads.sparkSession.read.parquet(path).groupBy("lane").agg(F.count("*").alias("n"), F.countDistinct("barcode").alias("n_barcodes"))


@query("reads", sql="""SELECT l_orderkey, l_linenumber, sequence FROM (SELECT *, row_number() OVER (PARTITION BY project, sample, lane ORDER BY l_orderkey, l_linenumber, l_partkey, sequence) - 1 AS read_idx FROM reads) t WHERE read_idx < 3""")
def t04_head_of_files(reads):
    place = F.expr("row_number() OVER (PARTITION BY project, sample, lane ORDER BY l_orderkey, l_linenumber, l_partkey, sequence) - 1")
    return reads.withColumn("read_idx", place).filter("read_idx < 3").select("l_orderkey", "l_linenumber", "sequence")


@query("reads", sql="SELECT project, sample, lane, sequence FROM (SELECT *, row_number() OVER (PARTITION BY project, sample, lane ORDER BY l_orderkey, l_linenumber, l_partkey, sequence) AS k FROM reads) t WHERE k = 1")
def t05_first_read(reads):
    return reads.groupBy(*UNIT).agg(F.min_by("sequence", F.struct("l_orderkey", "l_linenumber", "l_partkey", "sequence")).alias("sequence"))


# Barcodes ------------------------------------------------------------------------

COUNTS = "SELECT lane, barcode, count(*) AS n FROM reads GROUP BY lane, barcode"
RANK = "row_number() OVER (PARTITION BY lane ORDER BY n DESC, barcode)"


@query("reads", sql=COUNTS)
def a01_barcode_counts(reads):
    return C.counts(reads)


@query("reads", sql="SELECT lane, barcode, count(*) AS n FROM reads GROUP BY GROUPING SETS ((lane, barcode), (barcode))")
def a02_counts_grouping_sets(reads):
    return C.counts_at_both_grains(reads)


@query("reads", sql="SELECT count(*) AS n_reads, count(DISTINCT lane) AS n_lanes FROM reads")
def a38_totals(reads):
    return C.totals(C.counts(reads))


@query("reads", sql=COUNTS)
def u01_pooled_counts(reads):
    return C.pooled(C.counts(reads.filter("l_orderkey % 2 = 0")), C.counts(reads.filter("l_orderkey % 2 = 1")))


@query("reads", sql=f"SELECT lane, barcode, n, {RANK} AS rank FROM ({COUNTS}) t", longs="rank")
def w01_barcode_rank(reads):
    return C.ranked(C.counts(reads))


@query("reads", sql=f"SELECT lane, barcode, n, {RANK} AS rank, row_number() OVER (ORDER BY lane, n DESC, barcode) AS place FROM ({COUNTS}) t", longs="rank place")
def t01_sorted_counts(reads):
    """Places as of the rows in the order in which they come."""
    return shared.with_places(C.in_order(C.counts(reads)), "place")


SHARES = f"""SELECT lane, barcode, n, CAST(sum(n) OVER (PARTITION BY lane) AS BIGINT) AS lane_total,
 CAST(sum(n) OVER (PARTITION BY lane ORDER BY n DESC, barcode ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative FROM ({COUNTS}) t"""


@query("reads", sql=f"SELECT *, n * CAST(100 AS DOUBLE) / lane_total AS percent, cumulative * CAST(100 AS DOUBLE) / lane_total AS cumulative_percent FROM ({SHARES}) s")
def w02_cumulative_share(reads):
    return C.shares(C.counts(reads))


@query("reads", sql=f"SELECT lane, barcode, n, lane_total FROM ({SHARES}) s WHERE n >= floor(lane_total * 0.01)")
def p03_cutoff(reads):
    return C.above(C.counts(reads), 0.01)


@query("reads", sql=f"SELECT lane, barcode, n FROM ({SHARES}) s WHERE n >= floor(lane_total * 0.000001)")
def p04_weeding(reads):
    return G.weeded(C.counts(reads), 1e-6)


TWICE = "(SELECT lane, sample, index_seq, 1 AS line_no FROM sample_sheet UNION ALL SELECT lane, 'again' || sample, index_seq, 2 FROM sample_sheet WHERE lane = 2)"


def _twice(sheet):
    """Sheet rows of lane 2 come twice; the last counts."""
    rows = sheet.select("lane", "sample", "index_seq")
    again = rows.filter("lane = 2").withColumn("sample", F.concat(F.lit("again"), "sample"))
    return rows.withColumn("line_no", F.lit(1)).unionByName(again.withColumn("line_no", F.lit(2)))


@query("reads", "sample_sheet", sql=f"SELECT c.lane, c.barcode, c.n, s.sample FROM ({COUNTS}) c LEFT JOIN (SELECT lane, index_seq, arg_max(sample, line_no) AS sample FROM {TWICE} t GROUP BY lane, index_seq) s ON s.lane = c.lane AND s.index_seq = c.barcode")
def j01_sample_lookup(reads, sheet):
    return C.with_samples(C.counts(reads), _twice(sheet))


@query("reads", "sample_sheet", sql=f"SELECT c.lane, c.barcode, c.n, s.sample FROM ({COUNTS}) c LEFT JOIN (SELECT DISTINCT index_seq, sample FROM sample_sheet) s ON s.index_seq = c.barcode")
def j01_lookup_without_lanes(reads, sheet):
    return C.with_samples(C.counts(reads), sheet.select("sample", "index_seq").distinct().withColumn("lane", F.lit(None).cast("int")))


@query("reads", "sample_sheet", sql="""
WITH s AS (SELECT index_seq, string_agg(DISTINCT sample, ',' ORDER BY sample) AS samples FROM sample_sheet GROUP BY index_seq)
SELECT barcode, n, samples FROM (SELECT barcode, count(*) AS n FROM reads GROUP BY barcode) c LEFT JOIN s ON s.index_seq = c.barcode""")
def j02_samples_over_lanes(reads, sheet):
    return C.samples_over_lanes(reads.groupBy("barcode").agg(F.count("*").alias("n")), sheet)


def _apart(a: str, b: str, n: bool = False) -> str:
    other = f" OR substr({a}, i, 1) = 'N' OR substr({b}, i, 1) = 'N'" if n else ""
    return f"(SELECT count(*) FROM (SELECT unnest(range(1, length({a}) + 1)) AS i) z WHERE substr({a}, i, 1) <> substr({b}, i, 1){other})"


@query("reads", "sample_sheet", sql=f"""
WITH c AS (SELECT lane, barcode, n FROM ({SHARES}) s WHERE n >= floor(lane_total * 0.001)),
e AS (SELECT c.*, s.sample FROM c LEFT JOIN sample_sheet s ON s.lane = c.lane AND s.index_seq = c.barcode),
p AS (SELECT e.lane, e.barcode, s.sample FROM e JOIN sample_sheet s ON s.lane = e.lane WHERE e.sample IS NULL AND length(s.index_seq) = length(e.barcode) AND {_apart('s.index_seq', 'e.barcode', True)} <= 2),
g AS (SELECT lane, barcode, string_agg(DISTINCT sample, ',' ORDER BY sample) AS near FROM p GROUP BY lane, barcode)
SELECT e.lane, e.barcode, e.n, coalesce(e.sample, g.near) AS sample FROM e LEFT JOIN g ON g.lane = e.lane AND g.barcode = e.barcode""")
def j03_closest_samples(reads, sheet):
    return C.closest_samples(C.above(C.counts(reads), 0.001).drop("lane_total"), sheet, 2)


REFS = "SELECT DISTINCT index_seq FROM sample_sheet"


@query("reads", "sample_sheet", sql=f"""
WITH p AS (SELECT b.barcode, r.index_seq, {_apart('b.barcode', 'r.index_seq')} AS d FROM (SELECT DISTINCT barcode FROM reads) b CROSS JOIN ({REFS}) r),
m AS (SELECT barcode, min(index_seq) AS assigned FROM p WHERE d <= 1 GROUP BY barcode)
SELECT l_orderkey, l_linenumber, reads.barcode, coalesce(m.assigned, 'undetermined') AS assigned FROM reads LEFT JOIN m ON m.barcode = reads.barcode""")
def j04_assign_reads(reads, sheet):
    return C.assign(reads, sheet, 1).select("l_orderkey", "l_linenumber", "barcode", "assigned")


@query("reads", "sample_sheet", sql=f"""
WITH p AS (SELECT b.barcode, r.index_seq, {_apart('b.barcode', 'r.index_seq')} AS d FROM (SELECT DISTINCT barcode FROM reads) b CROSS JOIN ({REFS}) r),
m AS (SELECT barcode, min(index_seq) AS assigned FROM p WHERE d <= 1 GROUP BY barcode),
k AS (SELECT barcode, CASE WHEN l_linenumber = 7 THEN 'no partner' WHEN l_linenumber % 5 = 0 THEN 'barcodes differ' END AS error FROM reads)
SELECT CASE WHEN error IS NULL THEN coalesce(m.assigned, 'undetermined') END AS assigned, error, count(*) AS n FROM k LEFT JOIN m ON m.barcode = k.barcode GROUP BY ALL""")
def j05_assign_pairs(reads, sheet):
    named = reads.withColumn("name_key", F.concat_ws(":", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"), "sequence", "barcode"))
    named = named.repartition("name_key").groupBy("name_key", "barcode").agg(F.min("l_linenumber").alias("l_linenumber"), F.count("*").alias("n"))
    second = named.filter("l_linenumber <> 7").withColumn("barcode", F.when(F.col("l_linenumber") % 5 == 0, F.concat(F.lit("-"), "barcode")).otherwise(F.col("barcode")))
    return C.assigned_pairs(named, second, sheet, 1, keep=("n",), barcodes=reads).groupBy("assigned", "error").agg(F.sum("n").alias("n"))


@query("sample_sheet", sql=f"""SELECT * FROM (SELECT a.index_seq AS index_a, b.index_seq AS index_b, {_apart('a.index_seq', 'b.index_seq')} AS distance
 FROM ({REFS}) a JOIN ({REFS}) b ON a.index_seq < b.index_seq) t WHERE distance <= 4""")
def j06_ambiguity(sheet):
    return C.ambiguous(sheet, 4).withColumn("distance", F.col("distance").cast("long"))


NUMBERED = "(SELECT *, lane * 1000 + CAST(substr(sample, 2) AS INT) AS line_no FROM sample_sheet)"
COLLIDE = f"""SELECT a.lane, a.sample AS sample_a, b.sample AS sample_b, {_apart('a.index_seq', 'b.index_seq')} AS distance
 FROM {NUMBERED} a JOIN {NUMBERED} b ON a.lane = b.lane AND a.line_no < b.line_no"""


@query("sample_sheet", sql=f"SELECT * FROM ({COLLIDE}) t WHERE distance < 5")
def j07_collisions(sheet):
    return C.collisions(_lined(sheet), 2).withColumn("distance", F.col("distance").cast("long"))


COLLIDE_I7 = f"""WITH s AS (SELECT lane, 'T' || CAST(line_no % 3 AS VARCHAR) AS sample, line_no, substr(index_seq, 1, 4) AS i FROM {NUMBERED} n)
SELECT a.lane, a.sample AS sample_a, b.sample AS sample_b, {_apart('a.i', 'b.i')} AS distance FROM s a JOIN s b ON a.lane = b.lane AND a.line_no < b.line_no"""


@query("sample_sheet", sql=f"SELECT * FROM ({COLLIDE_I7}) t WHERE distance < 3")
def j07_collisions_of_one_index(sheet):
    """Several rows of a sample, dual indexes, of which the first is compared."""
    lined = _lined(sheet)
    dual = F.concat_ws("+", F.substring("index_seq", 1, 4), F.substring("index_seq", 5, 4))
    rows = lined.select("lane", F.concat(F.lit("T"), (F.col("line_no") % 3).cast("string")).alias("sample"), dual.alias("index_seq"), "line_no")
    return C.collisions(rows, 1, "1").withColumn("distance", F.col("distance").cast("long"))


WHOLE = "(SELECT DISTINCT sample, index_seq FROM sample_sheet)"


@query("reads", "sample_sheet", sql=f"""
WITH s AS (SELECT *, CAST(substr(sample, 2) AS INT) AS line_no FROM {WHOLE} w),
c AS (SELECT count(*) AS n FROM s a JOIN s b ON a.line_no < b.line_no WHERE {_apart('a.index_seq', 'b.index_seq')} < 3),
l AS (SELECT DISTINCT lane FROM reads UNION ALL SELECT NULL)
SELECT l.lane, CASE WHEN (SELECT min(length(index_seq)) FROM s) >= 6 AND c.n = 0 THEN 1 ELSE 0 END AS mismatches FROM l, c""")
def a37_mismatch_limit_without_lanes(reads, sheet):
    """A sheet that names no lanes: its limit holds for all lanes that have reads."""
    rows = sheet.select("sample", "index_seq").distinct()
    rows = rows.withColumns({"lane": F.lit(None).cast("int"), "line_no": F.substring("sample", 2, 9).cast("int")})
    return C.mismatch_limit(rows, C.counts(reads))


@query("sample_sheet", sql=f"""WITH c AS (SELECT DISTINCT lane FROM ({COLLIDE}) t WHERE distance < 3)
SELECT s.lane, CASE WHEN min(length(index_seq)) >= 6 AND s.lane NOT IN (SELECT lane FROM c) THEN 1 ELSE 0 END AS mismatches FROM sample_sheet s GROUP BY s.lane""")
def a37_mismatch_limit(sheet):
    return C.mismatch_limit(sheet)


@query("reads", sql=f"SELECT l_orderkey, l_linenumber, {_apart('barcode', 'o')} AS distance FROM (SELECT *, substr(sequence, 1, 8) AS o FROM reads) r")
def e10_hamming(reads):
    d = B.hamming(F.col("barcode"), F.substring("sequence", 1, 8))
    return reads.select("l_orderkey", "l_linenumber", d.cast("long").alias("distance"))


@query("reads", sql=f"SELECT l_orderkey, l_linenumber, {_apart('b', 's')} AS distance FROM (SELECT *, substr(barcode, 1, least(8, length(sequence))) AS b, substr(sequence, 1, 8) AS s FROM reads) r")
def e11_hamming_truncated(reads):
    return reads.select("l_orderkey", "l_linenumber", B.hamming_truncated(F.col("barcode"), F.col("sequence")).cast("long").alias("distance"))


@query("reads", sql=f"SELECT l_orderkey, l_linenumber, {_apart('barcode', 'o', True)} AS distance FROM (SELECT *, substr(sequence, 1, 8) AS o FROM reads) r")
def e12_hamming_n(reads):
    d = B.hamming_with_n(F.col("barcode"), F.substring("sequence", 1, 8))
    return reads.select("l_orderkey", "l_linenumber", d.cast("long").alias("distance"))


@query("reads", sql=f"""SELECT l_orderkey, l_linenumber, {_apart('barcode', 'o', True)} <= 4 AND {_apart("barcode", "p", True)} <= 4 AS near
 FROM (SELECT *, substr(sequence, 1, 8) AS o, substr(sequence, 9, 8) AS p FROM reads) r""")
def e13_dual_match(reads):
    two = F.concat_ws("+", "barcode", "barcode")
    other = F.concat_ws("+", F.substring("sequence", 1, 8), F.substring("sequence", 9, 8))
    return reads.select("l_orderkey", "l_linenumber", B.matches(two, other, 4).alias("near"))


@query("reads", sql="SELECT lane, length(barcode) AS length, count(*) AS n FROM reads GROUP BY ALL", ints="length")
def e14_barcode_lengths(reads):
    dual = F.concat_ws("+", F.substring("barcode", 1, 4), F.substring("barcode", 5, 8))
    return reads.select("lane", B.barcode_length(dual).alias("length")).groupBy("lane", "length").agg(F.count("*").alias("n"))


@query("reads", sql="SELECT regexp_matches(barcode, '^[ATGC]*$') AS valid, count(*) AS n FROM reads GROUP BY ALL")
def e15_barcode_valid(reads):
    return reads.groupBy(B.is_valid(F.col("barcode")).alias("valid")).agg(F.count("*").alias("n"))


@query("sample_sheet", sql="SELECT lane, bool_or(CAST(substr(sample, 2) AS INT) % 13 BETWEEN 1 AND 12) AS has_plate FROM sample_sheet GROUP BY lane")
def e16_plate_indices(sheet):
    made = F.concat(F.lit("SI-GA-A"), (F.substring("sample", 2, 3).cast("int") % 13).cast("string"))
    return sheet.groupBy("lane").agg(F.bool_or(B.plate_index(made)).alias("has_plate"))


@query("sample_sheet", sql="SELECT sample, lane, CASE WHEN lane = 3 THEN '__10X__' ELSE repeat('N', length(index_seq)) END AS shape, CAST(4 AS STRING) || 'x' || CAST(length(index_seq) - 4 AS STRING) AS lengths FROM sample_sheet")
def e27_index_shape(sheet):
    """Lane 3's indexes are pool identifiers."""
    dual = F.concat_ws("-", F.substring("index_seq", 1, 4), F.substring("index_seq", 5, 8))
    index = F.when(F.col("lane") == 3, F.concat(F.lit("SI-GA-"), "sample")).otherwise(F.col("index_seq"))
    return sheet.select("sample", "lane", B.masked_shape(index).alias("shape"), B.length_label(dual).alias("lengths"))


@query("reads", sql="SELECT l_orderkey, l_linenumber, substr(sequence, 1, 5) AS barcode, substr(sequence, 6) AS sequence, substr(quality, 6) AS quality FROM reads")
def e08_trim_barcode(reads):
    made = B.trimmed_inline(F.col("sequence"), F.col("quality"), 5)
    return reads.select("l_orderkey", "l_linenumber", *[c.alias(k) for k, c in made.items()])


@query("reads", sql="SELECT substr(sequence, 3, 4) AS part, count(*) AS n FROM reads GROUP BY ALL")
def e09_subsequence_counts(reads):
    return reads.groupBy(B.subsequence(F.col("sequence"), 3, 6).alias("part")).agg(F.count("*").alias("n"))


KIND = "CASE WHEN length(trim(sequence, 'N')) = 0 THEN 'masked' WHEN length(trim(sequence, 'N')) < length(sequence) THEN 'padded' ELSE 'clean' END"


@query("reads", sql=f"SELECT {KIND} AS kind, count(*) AS n FROM (SELECT CASE WHEN l_partkey % 19 = 0 THEN '' ELSE sequence END AS sequence FROM reads) r GROUP BY ALL")
def e18_read_kind(reads):
    reads = reads.withColumn("sequence", F.when(F.col("l_partkey") % 19 == 0, "").otherwise(F.col("sequence")))
    kind = F.when(B.is_masked(F.col("sequence")), "masked").when(B.is_padded(F.col("sequence")), "padded").otherwise("clean")
    return reads.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


@query("reads", sql="SELECT lane, count(*) FILTER (project <> 'Undetermined_indices') * 100.0 / count(*) AS p, NULL::DOUBLE AS none FROM reads GROUP BY lane")
def e26_percent(reads):
    n = reads.groupBy("lane").agg(F.count(F.when(F.col("project") != S.UNDETERMINED, 1)).alias("a"), F.count("*").alias("t"))
    return n.select("lane", B.percent(F.col("a"), F.col("t")).alias("p"), B.percent(F.col("a"), F.col("t") - F.col("t")).alias("none"))


@query("reads", sql="""SELECT l_orderkey, l_linenumber, CAST(l_linenumber % 2 + 1 AS INT) AS read_number, CASE WHEN l_linenumber % 2 = 0 THEN substr(sequence, 3, 10) ELSE sequence END AS sequence,
 CASE WHEN l_linenumber % 2 = 0 THEN substr(quality, 3, 10) ELSE quality END AS quality FROM reads WHERE project <> 'P1' OR sample LIKE 'S1%'""")
def e30_trim_range(reads):
    """Reads 1 are cut, reads 2 are not; of P1 only the listed samples are biological."""
    per = reads.select("project", "sample").distinct().groupBy("project").agg(
        F.array_agg(F.when((F.col("project") == "P1") & F.col("sample").startswith("S1"), F.col("sample"))).alias("listed"),
        F.array().cast("array<string>").alias("by_library"), F.array_agg("sample").alias("all"),
    )
    samples = R.biological_samples(per.withColumn("listed", F.array_compact("listed"))).select("project", F.explode("samples").alias("sample"))
    ranges = reads.sparkSession.createDataFrame([(1, 3, 12)], "read_number int, first int, last int")
    numbered = reads.withColumn("read_number", (F.col("l_linenumber") % 2 + 1).cast("int"))
    return D.trimmed(numbered, ranges, samples).select("l_orderkey", "l_linenumber", "read_number", "sequence", "quality")


REPORT = f"""SELECT c.lane, c.barcode, c.n, s.sample, c.cumulative, c.lane_total, row_number() OVER (PARTITION BY c.lane ORDER BY c.n DESC, c.barcode) AS rank
 FROM ({SHARES}) c LEFT JOIN sample_sheet s ON s.lane = c.lane AND s.index_seq = c.barcode WHERE c.n >= floor(c.lane_total * 0.001)"""


def _report(reads, sheet):
    return C.report(C.counts(reads), sheet, 0.001)


@query("reads", "sample_sheet", sql=f"SELECT lane, barcode, n, sample, cumulative, lane_total, rank, n * CAST(100 AS DOUBLE) / lane_total AS percent, cumulative * CAST(100 AS DOUBLE) / lane_total AS cumulative_percent FROM ({REPORT}) r", longs="rank")
def g04_report_exact(reads, sheet):
    return _report(reads, sheet)


UNDER = f"""SELECT s.lane, s.sample, s.index_seq, r.n FROM sample_sheet s LEFT JOIN ({REPORT}) r ON r.lane = s.lane AND r.barcode = s.index_seq
 WHERE NOT EXISTS (SELECT 1 FROM ({REPORT}) x WHERE x.lane = s.lane AND x.sample = s.sample)"""


ABSENT = "(SELECT * FROM sample_sheet UNION ALL SELECT lane, 'none' || sample, project, reverse(index_seq) || 'A' FROM sample_sheet WHERE lane = 1)"


@query("reads", "sample_sheet", sql=UNDER.replace("FROM sample_sheet s LEFT JOIN (", f"FROM {ABSENT} s LEFT JOIN ("))
def j11_underrepresented(reads, sheet):
    """The sheet has samples besides, whose barcodes no read has."""
    more = sheet.filter("lane = 1").withColumns({"sample": F.concat(F.lit("none"), "sample"), "index_seq": F.concat(F.reverse("index_seq"), F.lit("A"))})
    whole = sheet.unionByName(more)
    return C.underrepresented(_report(reads, sheet), whole.select("lane", "sample", "index_seq"))


OVER = f"SELECT lane, barcode, n, rank FROM (SELECT *, max(rank) FILTER (sample IS NOT NULL) OVER (PARTITION BY lane) AS lowest FROM ({REPORT}) r) t WHERE sample IS NULL AND rank < lowest"
#: A sheet that lacks every third sample, whose barcodes abound then.
LACKING = "(SELECT * FROM sample_sheet WHERE CAST(substr(sample, 2) AS INT) % 3 <> 1)"


def _lacking(sheet):
    return sheet.filter(F.substring("sample", 2, 9).cast("int") % 3 != 1)


@query("reads", "sample_sheet", sql=OVER.replace("LEFT JOIN sample_sheet s", f"LEFT JOIN {LACKING} s"), longs="rank")
def w04_overrepresented(reads, sheet):
    return C.overrepresented(_report(reads, _lacking(sheet))).select("lane", "barcode", "n", "rank")


@query("reads", "sample_sheet", sql=f"""WITH u AS (SELECT lane, count(*) AS n FROM ({UNDER}) a GROUP BY lane), o AS (SELECT lane, count(*) AS n FROM ({OVER}) b GROUP BY lane)
SELECT l.lane, coalesce(u.n, 0) AS n_under, coalesce(o.n, 0) AS n_over, coalesce(u.n, 0) + coalesce(o.n, 0) > 0 AS has_problems
FROM (SELECT DISTINCT lane FROM sample_sheet) l LEFT JOIN u ON u.lane = l.lane LEFT JOIN o ON o.lane = l.lane""")
def g05_problem_flag(reads, sheet):
    return C.problems(_report(reads, sheet), sheet)


#: Reads of which some have no lane, over lanes and over all: barcode counts by scope.
UNLANED = "(SELECT CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE lane END AS lane, barcode FROM reads)"
SCOPED = f"""SELECT scope, lane, barcode, n, CAST(sum(n) OVER w AS BIGINT) AS lane_total, CAST(sum(n) OVER (w ORDER BY n DESC, barcode ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative,
 row_number() OVER (w ORDER BY n DESC, barcode) AS rank FROM (SELECT CASE WHEN grouping(lane) = 1 THEN 'all' ELSE 'lane' END AS scope, lane, barcode, count(*) AS n
 FROM {UNLANED} u GROUP BY GROUPING SETS ((lane, barcode), (barcode))) c WINDOW w AS (PARTITION BY scope, lane)"""
ALL_LANES = f"""SELECT c.*, CASE WHEN scope = 'all' THEN a.samples ELSE s.sample END AS sample FROM ({SCOPED}) c LEFT JOIN sample_sheet s ON s.lane = c.lane AND s.index_seq = c.barcode
 LEFT JOIN (SELECT index_seq, string_agg(DISTINCT sample, ',' ORDER BY sample) AS samples FROM sample_sheet GROUP BY index_seq) a ON a.index_seq = c.barcode WHERE n >= floor(lane_total * 0.001)"""


def _unlaned(reads):
    return C.counts(reads.withColumn("lane", F.when(F.col("l_orderkey") % 7 != 0, F.col("lane"))))


@query("reads", "sample_sheet", sql=f"SELECT *, n * CAST(100 AS DOUBLE) / lane_total AS percent, cumulative * CAST(100 AS DOUBLE) / lane_total AS cumulative_percent FROM ({ALL_LANES}) r", longs="rank")
def g04_report_all_lanes(reads, sheet):
    """Each lane's report, that of reads without a lane, and that over all lanes."""
    return C.report(_unlaned(reads), sheet, 0.001, all_lanes=True)


@query("reads", "sample_sheet", sql=f"""
WITH r AS ({ALL_LANES}), t AS (SELECT scope, lane, CAST(sum(n) AS BIGINT) AS total_reads FROM ({SCOPED}) c GROUP BY scope, lane),
s AS (SELECT 'lane' AS scope, lane, sample FROM sample_sheet UNION ALL SELECT DISTINCT 'all', CAST(NULL AS INT), sample FROM sample_sheet),
f AS (SELECT DISTINCT scope, lane, unnest(string_split(sample, ',')) AS sample FROM r WHERE sample IS NOT NULL),
u AS (SELECT s.scope, s.lane, count(*) AS n FROM s LEFT JOIN f ON f.scope = s.scope AND f.lane IS NOT DISTINCT FROM s.lane AND f.sample = s.sample WHERE f.sample IS NULL GROUP BY s.scope, s.lane),
o AS (SELECT scope, lane, count(*) AS n FROM (SELECT *, max(rank) FILTER (sample IS NOT NULL) OVER (PARTITION BY scope, lane) AS lowest FROM r) x WHERE sample IS NULL AND rank < lowest GROUP BY scope, lane),
k AS (SELECT scope, lane, count(*) AS n, CAST(sum(n) AS BIGINT) AS coverage FROM r GROUP BY scope, lane)
SELECT t.scope, t.lane, total_reads, coalesce(k.n, 0) AS n_barcodes, coalesce(k.coverage, 0) AS coverage, coalesce(k.coverage, 0) * CAST(100 AS DOUBLE) / total_reads AS coverage_percent,
 coalesce(u.n, 0) AS n_under, coalesce(o.n, 0) AS n_over, coalesce(u.n, 0) + coalesce(o.n, 0) > 0 AS has_problems FROM t
 LEFT JOIN k ON k.scope = t.scope AND k.lane IS NOT DISTINCT FROM t.lane LEFT JOIN u ON u.scope = t.scope AND u.lane IS NOT DISTINCT FROM t.lane
 LEFT JOIN o ON o.scope = t.scope AND o.lane IS NOT DISTINCT FROM t.lane""")
def g04_report_summary(reads, sheet):
    """The reports' summary rows, in exact mode."""
    found = shared.cut(C.scoped(_unlaned(reads)))
    return C.summary(found, C.report(found, sheet, 0.001), sheet)


@query("reads")
def g01_group_all_lanes(reads):
    return G.grouped(_unlaned(reads), 2, cutoff=0.001, all_lanes=True)


@query("reads")
def g01_group_barcodes(reads):
    return G.grouped(C.counts(reads), 2)


@query("reads")
def g01_group_by_matches(reads):
    return G.grouped(C.counts(reads), 2, by_matches=True)


@query("reads", "sample_sheet")
def g02_seeded_groups(reads, sheet):
    return G.grouped(C.counts(reads), 1, cutoff=0.001, seeds=sheet)


def _analysed(reads, sheet):
    found = C.counts(reads)
    groups = G.grouped(found, 2, cutoff=0.001, seeds=sheet).withColumnRenamed("reference", "barcode")
    return C.analyse(found, groups, sheet, 2)


@query("reads", "sample_sheet")
def g03_analyse_grouped(reads, sheet):
    return _analysed(reads, sheet)[0]


@query("reads", "sample_sheet")
def g03_analysis_summary(reads, sheet):
    return _analysed(reads, sheet)[1]


# Lengths and qualities -----------------------------------------------------------


@query("reads", sql=f"""
WITH h AS (SELECT project, sample, lane, length(sequence) AS length, count(*) AS n FROM reads GROUP BY ALL),
c AS (SELECT *, sum(n) OVER (PARTITION BY project, sample, lane ORDER BY length) AS cum, sum(n) OVER (PARTITION BY project, sample, lane) AS t FROM h),
k AS (SELECT project, sample, lane, count(*) FILTER (({KIND}) = 'masked') AS m, count(*) FILTER (({KIND}) = 'padded') AS p FROM reads GROUP BY ALL)
SELECT c.project, c.sample, c.lane, CAST(sum(n) AS BIGINT) AS n_reads, k.m AS n_masked, k.p AS n_padded, min(length) AS min_length, max(length) AS max_length,
 CAST(sum(length * n) AS DOUBLE) / sum(n) AS mean_length, min(length) FILTER (cum >= t // 2) AS median_length, CAST(k.m AS DOUBLE) * 100 / CAST(sum(n) AS DOUBLE) AS frac_masked, CAST(k.p AS DOUBLE) * 100 / CAST(sum(n) AS DOUBLE) AS frac_padded
FROM c JOIN k ON k.project = c.project AND k.sample = c.sample AND k.lane = c.lane GROUP BY c.project, c.sample, c.lane, k.m, k.p""", ints="min_length max_length median_length")
def a09_seq_lengths(reads):
    return L.length_stats(reads, UNIT)


@query("reads", sql=f"SELECT project, sample, lane, length(sequence) AS length, count(*) AS n, count(*) FILTER (({KIND}) = 'masked') AS n_masked, count(*) FILTER (({KIND}) = 'padded') AS n_padded FROM reads GROUP BY ALL", ints="length")
def a10_length_hist(reads):
    return L.length_histogram(reads, UNIT)


@query("reads", sql="SELECT lane, min(length(sequence)) AS min_length, max(length(sequence)) AS max_length, count(*) AS n_reads FROM reads GROUP BY ROLLUP (lane)", ints="min_length max_length")
def a11_length_ranges(reads):
    return L.length_ranges(reads, "lane")


@query("reads", sql="""
WITH x AS (SELECT lane, i AS position, ascii(substr(quality, CAST(i AS INT), 1)) - 33 AS score FROM (SELECT lane, quality, unnest(range(1, length(quality) + 1)) AS i FROM reads) t),
h AS (SELECT lane, position, score, count(*) AS n FROM x GROUP BY ALL),
c AS (SELECT *, sum(n) OVER (PARTITION BY lane, position ORDER BY score) AS cum, sum(n) OVER (PARTITION BY lane, position) AS t FROM h)
SELECT lane, CAST(position AS INT) AS position, CAST(sum(score * n) AS DOUBLE) / sum(n) AS mean, min(score) FILTER (cum > t // 2) AS median, min(score) FILTER (cum > (t // 2) // 2) AS q25,
 min(score) FILTER (cum > least((t // 2) // 2 + t // 2, t - 1)) AS q75, min(score) FILTER (cum > t // 10) AS p10, min(score) FILTER (cum > least(t - t // 10, t - 1)) AS p90
FROM c GROUP BY lane, position""")
def a12_base_quality(reads):
    return L.quality_stats(reads, ("lane",))


@query("series", sql="""WITH m AS (SELECT *, max(x) OVER (PARTITION BY series) AS top FROM series),
b AS (SELECT series, y, CAST(CASE WHEN top > 50 THEN floor(CAST(x AS DOUBLE) / top * 49 + 0.5) ELSE x END AS BIGINT) AS bin FROM m)
SELECT series, bin, avg(y) AS mean_y, min(y) AS min_y, max(y) AS max_y FROM b GROUP BY series, bin""")
def a34_rebin(series):
    return L.rebinned(series, 50)


@query("series", sql="SELECT series, x, y, CASE WHEN max(y) OVER (PARTITION BY series) > 10 THEN y / max(y) OVER (PARTITION BY series) * 10 ELSE y END AS scaled FROM series")
def a35_rescale(series):
    return L.rescaled(series, 10.0)


@query("reads", sql="""WITH h AS (SELECT lane, length(sequence) AS length, count(*) AS n FROM reads GROUP BY ALL)
SELECT lane, length, n, sum(n) OVER (PARTITION BY lane ORDER BY length) * 100.0 / sum(n) OVER (PARTITION BY lane) AS "end",
 (sum(n) OVER (PARTITION BY lane ORDER BY length) - n) * 100.0 / sum(n) OVER (PARTITION BY lane) AS start FROM h""", ints="length")
def w07_stacked_bar(reads):
    h = reads.groupBy("lane", F.length("sequence").alias("length")).agg(F.count("*").alias("n"))
    return L.stacked(h, "lane", "length", "n", 100)


@query("reads", sql="""WITH h AS (SELECT lane, length(sequence) AS length, count(*) AS n FROM reads GROUP BY ALL),
c AS (SELECT *, sum(n) OVER (PARTITION BY lane ORDER BY length) AS cum, sum(n) OVER (PARTITION BY lane) AS t FROM h)
SELECT lane, min(length) FILTER (cum > t // 10) AS p10 FROM c GROUP BY lane""", ints="p10")
def w06_histogram_place(reads):
    h = reads.groupBy("lane", F.length("sequence").alias("length")).agg(F.count("*").alias("n"))
    return L.value_at(h, ("lane",), "length", "n", F.floor(F.col("_total") / 10), "p10", inclusive=False)


@query("reads", sql=f"""SELECT project || '_' || sample || '_' || CAST(lane AS VARCHAR) AS fastq, min(length(sequence)) AS "min", max(length(sequence)) AS "max", avg(length(sequence)) AS mean, count(*) AS nreads,
 count(*) FILTER (({KIND}) = 'masked') AS masked, count(*) FILTER (({KIND}) = 'padded') AS padded,
 CAST(count(*) FILTER (({KIND}) = 'masked') AS DOUBLE) * 100 / CAST(count(*) AS DOUBLE) AS masked_frac, CAST(count(*) FILTER (({KIND}) = 'padded') AS DOUBLE) * 100 / CAST(count(*) AS DOUBLE) AS padded_frac
FROM reads GROUP BY project, sample, lane""", ints="min max")
def s23_collated_lengths(reads):
    table = L.collated(L.length_stats(reads.withColumn("file", _file())))
    path = shared.new_folder(reads.sparkSession, "collated")
    L.write_collated(table, path)
    return reads.sparkSession.read.option("sep", "\t").option("header", True).schema(table.schema).csv(path)


@query("reads", "fastq_files", sql="""SELECT f.fastq, f.n_reads, r.max_length FROM (SELECT * FROM fastq_files WHERE read_number = 1 AND NOT is_index) f LEFT JOIN
 (SELECT project, sample, lane, max(length(sequence)) AS max_length FROM reads GROUP BY ALL) r ON r.project = f.project AND r.sample = f.sample AND r.lane = f.lane""", ints="max_length")
def j15_stats_with_lengths(reads, files):
    stats = L.length_stats(reads, UNIT).select(*UNIT, "max_length")
    return S.first_reads(files).join(stats, list(UNIT), "left").select("fastq", "n_reads", "max_length")


# Names ---------------------------------------------------------------------------

ATTRS_SQL = r"regexp_extract(fastq, '_S([0-9]+)_L', 1)"


@query("fastq_files", sql="SELECT fastq, replace(fastq, '.fastq.gz', '') AS name, '.fastq.gz' AS extension, 'gz' AS compression, 'fastq' AS type FROM fastq_files")
def e01_file_parts(files):
    p = F.concat(F.lit("/data/run/"), "fastq")
    return files.select("fastq", N.basename(p).alias("name"), N.extension(p).alias("extension"), N.compression(p).alias("compression"), N.file_type(p).alias("type"))


@query("fastq_files", sql=f"""SELECT fastq, split_part(fastq, '_', 1) AS sample_name, CAST({ATTRS_SQL} AS INT) AS sample_number, NULL::VARCHAR AS barcode_sequence, lane AS lane_number,
 read_number, 1 AS set_number, is_index AS is_index_read FROM fastq_files""")
def e02_name_attrs(files):
    return files.select("fastq", *[c.alias(k) for k, c in N.illumina_attrs(F.col("fastq")).items()])


@query("fastq_files", sql="SELECT fastq, project || '.' || sample AS sample_name, 'ACGT' AS barcode_sequence, read_number FROM fastq_files")
def e03_dotted_names(files):
    p = F.concat("project", F.lit("."), "sample", F.lit(".ACGT.r"), F.col("read_number").cast("string"), F.lit(".fastq"))
    return files.select("fastq", *[c.alias(k) for k, c in N.dotted_attrs(p).items()])


@query("lineitem", sql="SELECT DISTINCT 'SRR' || l_orderkey || CASE WHEN l_linenumber < 3 THEN '_' || l_linenumber ELSE '' END AS name, 'SRR' || l_orderkey AS sample_name, CASE WHEN l_linenumber < 3 THEN l_linenumber ELSE 1 END AS read_number, l_linenumber >= 3 AS implicit_read FROM lineitem")
def e04_accession_names(lineitem):
    name = F.concat(F.lit("SRR"), F.col("l_orderkey").cast("string"), F.when(F.col("l_linenumber") < 3, F.concat(F.lit("_"), F.col("l_linenumber").cast("string"))).otherwise(""))
    return lineitem.select(name.alias("name")).distinct().select("name", *[c.alias(k) for k, c in N.accession_attrs(F.concat("name", F.lit(".fastq.gz"))).items()])


@query("fastq_files", sql="SELECT fastq, replace(fastq, '.fastq.gz', '') AS canonical, '_trimmed_x' || lane AS extras FROM fastq_files")
def e05_extras(files):
    p = F.concat(F.replace("fastq", F.lit(".fastq.gz")), F.lit("_trimmed_x"), F.col("lane").cast("string"), F.lit(".fastq"))
    name, extras = N.canonical_and_extras(p)
    return files.select("fastq", name.alias("canonical"), extras.alias("extras"))


@query("fastq_files", sql=r"SELECT fastq, regexp_replace(replace(fastq, '.fastq.gz', ''), '_L00[0-9]', '') AS merged, regexp_replace(replace(fastq, '.fastq.gz', ''), '_[RI][0-9]', '') AS bam FROM fastq_files")
def e06_e07_rebuilt_names(files):
    return files.select("fastq", N.changed(F.col("fastq"), lane_number=None).alias("merged"), N.bam_name(F.col("fastq")).alias("bam"))


@query("documents", sql=r"SELECT doc_id, regexp_matches(text, '[^\x20-\x7F\n\t]') AS bad FROM documents")
def e17_bad_characters(documents):
    return documents.select("doc_id", N.has_invalid_characters(F.col("text")).alias("bad"))


@query("customer", sql="SELECT c_custkey, 'S-|' || lpad(CAST(c_custkey AS VARCHAR), 20, '0') || '|_b|' || lpad(CAST(c_nationkey AS VARCHAR), 20, '0') AS key FROM customer")
def e19_natural_sort(customer):
    name = F.concat(F.lit("S-"), F.col("c_custkey").cast("string"), F.lit("_b"), F.col("c_nationkey").cast("string"))
    return customer.select("c_custkey", F.array_join(N.natural_key(name), "|").alias("key"))


@query("sample_sheet", sql="SELECT sample, row_number() OVER (ORDER BY CAST(substr(sample, 2) AS INT)) AS place FROM (SELECT DISTINCT sample FROM sample_sheet) t")
def t02_natural_order(sheet):
    """Names of samples are some thousands: a small window."""
    names = sheet.select("sample").distinct()
    return names.select("sample", F.row_number().over(Window.orderBy(N.natural_key(F.col("sample")))).cast("long").alias("place"))


RUNS = "(SELECT o_orderkey, '2' || CAST(30101 + o_orderkey % 28 AS VARCHAR) || '_M0' || CAST(o_orderkey % 9 AS VARCHAR) || '_' || lpad(CAST(o_orderkey % 500 AS VARCHAR), 4, '0') || '_AHXX' || CAST(o_custkey % 100 AS VARCHAR) AS run, CAST(o_orderkey % 7 AS INT) AS facility, CAST(o_orderkey % 500 AS INT) AS number, o_custkey FROM orders) r"


def _runs(orders):
    k = F.col("o_orderkey")
    s = lambda c: c.cast("string")
    run = F.concat(F.lit("2"), s(30101 + k % 28), F.lit("_M0"), s(k % 9), F.lit("_"), F.lpad(s(k % 500), 4, "0"), F.lit("_AHXX"), s(F.col("o_custkey") % 100))
    return orders.select("o_orderkey", run.alias("run"), (k % 7).cast("int").alias("facility"))


RUN_ID = "'MISEQ_' || split_part(run, '_', 1) || CASE WHEN number <> facility THEN '/' || number ELSE '' END || '#' || facility || CASE WHEN o_orderkey % 5 = 0 THEN '.2' ELSE '' END"


@query("orders", sql=f"SELECT o_orderkey, {RUN_ID} AS id, {RUN_ID} || CASE WHEN o_orderkey % 3 = 0 THEN '_SP' ELSE '' END AS reference FROM {RUNS}")
def e20_run_ids(orders):
    r, k = _runs(orders), F.col("o_orderkey")
    id_ = N.run_id(F.col("run"), F.lit("miseq"), F.col("facility"), F.when(k % 5 == 0, 2))
    return r.select("o_orderkey", id_.alias("id"), N.run_reference(id_, F.when(k % 3 == 0, "SP")).alias("reference"))


@query("orders", sql=f"SELECT o_orderkey, CAST(strptime(split_part(run, '_', 1), '%y%m%d') AS DATE) AS run_date, split_part(run, '_', 2) AS instrument, number AS run_number, 'HXX' || CAST(o_custkey % 100 AS VARCHAR) AS flow_cell_id FROM {RUNS}")
def e29_run_names(orders):
    p = N.run_parts(F.col("run"))
    return _runs(orders).select("o_orderkey", *[p[k].alias(k) for k in ("run_date", "instrument", "run_number", "flow_cell_id")])


@query("sample_sheet", sql="""SELECT ref, CASE k WHEN 0 THEN 'R#1' WHEN 1 THEN 'R#1' END AS run, CASE k WHEN 0 THEN project WHEN 2 THEN project END AS project, CASE k WHEN 0 THEN sample END AS sample FROM
 (SELECT k, project, sample, CASE k WHEN 0 THEN 'R#1:' || project || '/' || sample WHEN 1 THEN 'R#1' ELSE ':' || project END AS ref FROM sample_sheet, (SELECT unnest([0, 1, 2]) AS k) z) t""")
def e21_sample_references(sheet):
    refs = F.array(F.concat(F.lit("R#1:"), "project", F.lit("/"), "sample"), F.lit("R#1"), F.concat(F.lit(":"), "project"))
    return sheet.select(F.explode(refs).alias("ref")).select("ref", *[c.alias(k) for k, c in N.sample_reference(F.col("ref")).items()])


@query("customer", sql="""SELECT c_custkey, CASE WHEN f = 0 AND r = 0 THEN 'undetermined' WHEN r = 0 OR f / r > 5 THEN 'forward' WHEN f / r < 0.2 THEN 'reverse' ELSE 'unstranded?' END AS label,
 CASE WHEN 10 > f AND 10 > r THEN 'none' WHEN f / (r + 0.001) < 0.2 THEN 'reverse' WHEN f / (r + 0.001) > 5 THEN 'forward' ELSE 'none' END AS protocol
FROM (SELECT c_custkey, CAST(c_custkey % 11 * (c_custkey % 3) AS DOUBLE) AS f, CAST(c_custkey % 7 AS DOUBLE) AS r FROM customer) t""")
def e22_e31_strands(customer):
    f, r = (F.col("c_custkey") % 11 * (F.col("c_custkey") % 3)).cast("double"), (F.col("c_custkey") % 7).cast("double")
    return customer.select("c_custkey", N.strand_label(f, r).alias("label"), N.strand_protocol(f, r, F.lit(10.0)).alias("protocol"))


@query("registry", sql=r"SELECT project, trim(regexp_replace(lower(trim(o)), '\s+', '_', 'g'), '_') AS organism FROM (SELECT project, unnest(string_split(organism, ',')) AS o FROM registry) t")
def e23_organisms(registry):
    return registry.select("project", F.explode(N.organisms(F.col("organism"))).alias("organism"))


@query("events", sql="SELECT DISTINCT event_type, upper(substr(event_type, 1, 1)) || substr(event_type, 2) || ' x' AS label, lower(event_type) || '_x' AS key FROM events")
def e24_labels(events):
    key = F.concat(F.lower("event_type"), F.lit("_x"))
    return events.select("event_type").distinct().select("event_type", N.label_of(key).alias("label"), N.key_of(N.label_of(key)).alias("key"))


@query("registry", sql="SELECT project, concat_ws('/', user_name, pi, CASE WHEN library <> '' THEN library END) AS field FROM registry")
def e25_composite(registry):
    return registry.select("project", N.composite("/", F.col("user_name"), F.col("pi"), F.col("library")).alias("field"))


@query("fastq_files", sql="SELECT fastq, CASE WHEN NOT is_index THEN split_part(fastq, '_', 1) END AS sample_name, CASE WHEN NOT is_index THEN read_number END AS read_number FROM fastq_files")
def x01_custom_pattern(files):
    made = N.custom_attrs(F.col("fastq"), "{SAMPLE}_S*_R{READ}_*")
    return files.select("fastq", *[c.alias(k) for k, c in made.items()])


ODD_NAMES = "(SELECT fastq, project, sample, lane, read_number, sample || '_ACGT' || CASE WHEN lane % 2 = 0 THEN '+' ELSE '-' END || 'TTGA' AS tagged FROM fastq_files WHERE NOT is_index)"


def _odd_names(files):
    tagged = F.concat("sample", F.lit("_ACGT"), F.when(F.col("lane") % 2 == 0, "+").otherwise("-"), F.lit("TTGA"))
    return files.filter("NOT is_index").select("fastq", "project", "sample", "lane", "read_number", tagged.alias("tagged"))


@query("fastq_files", sql=f"""SELECT fastq, sample AS sample_name, NULL::INT AS sample_number, substr(tagged, length(sample) + 2) AS barcode_sequence, lane AS lane_number,
 read_number, CASE WHEN lane > 2 THEN 1 END AS set_number, FALSE AS is_index_read FROM {ODD_NAMES} f""", ints="lane_number read_number set_number")
def e02_tags_of_two_indexes(files):
    name = F.concat("tagged", F.lit("_L00"), F.col("lane").cast("string"), F.lit("_R"), F.col("read_number").cast("string"), F.when(F.col("lane") > 2, "_001").otherwise(""), F.lit(".fastq"))
    return _odd_names(files).select("fastq", *[c.alias(k) for k, c in N.illumina_attrs(name).items()])


@query("fastq_files", sql=f"SELECT fastq, CASE read_number WHEN 1 THEN tagged || '_L00' || lane ELSE sample || '_a_b' END AS canonical, CASE read_number WHEN 1 THEN '_trimmed_' || lane END AS extras FROM {ODD_NAMES} f")
def e05_extras_without_a_read(files):
    """Names without a read field, and such that tell nothing."""
    lane = F.col("lane").cast("string")
    name = F.when(F.col("read_number") == 1, F.concat("tagged", F.lit("_L00"), lane, F.lit("_trimmed_"), lane)).otherwise(F.concat("sample", F.lit("_a_b")))
    canonical, extras = N.canonical_and_extras(F.concat(name, F.lit(".fastq.gz")))
    return _odd_names(files).select("fastq", canonical.alias("canonical"), extras.alias("extras"))


@query("fastq_files", sql=f"""SELECT fastq, project || '_' || sample AS sample_name, read_number, project || '_' || sample || '_x' || lane || '_' || CAST(3 - read_number AS INT) AS other,
 project || '_' || sample || '_x' || lane AS bam FROM {ODD_NAMES} f""", ints="read_number")
def x01_greedy_pattern(files):
    """Samples with separators in their names; names are rebuilt with the other read, and
    without one."""
    names = N.CustomNames("{SAMPLE}_*_{READ}")
    path = F.concat("project", F.lit("_"), "sample", F.lit("_x"), F.col("lane").cast("string"), F.lit("_"), F.col("read_number").cast("string"), F.lit(".fastq"))
    return _odd_names(files).select("fastq", *[c.alias(k) for k, c in names(path).items()], names.renamed(path, 3 - F.col("read_number")).alias("other"), names.bam_name(path).alias("bam"))


@query("fastq_files", sql="""WITH f AS (SELECT DISTINCT project || '_' || sample || '_x' || lane AS s, read_number FROM fastq_files WHERE NOT is_index AND NOT (read_number = 2 AND lane = 4))
SELECT a.s || '_1.fastq' AS r1, CASE WHEN b.s IS NOT NULL THEN b.s || '_2.fastq' END AS r2 FROM (SELECT s FROM f WHERE read_number = 1) a LEFT JOIN (SELECT s FROM f WHERE read_number = 2) b ON a.s = b.s""")
def x01_pairs_by_pattern(files):
    """What the wildcard holds tells sets apart."""
    kept = _odd_names(files).filter("NOT (read_number = 2 AND lane = 4)")
    path = F.concat("project", F.lit("_"), "sample", F.lit("_x"), F.col("lane").cast("string"), F.lit("_"), F.col("read_number").cast("string"), F.lit(".fastq"))
    return P.pairs_by_name(kept.select(path.alias("fastq")).distinct(), N.CustomNames("{SAMPLE}_*_{READ}"))


@query("fastq_files", sql="""WITH f AS (SELECT DISTINCT project || '.' || sample || CAST(lane AS VARCHAR) AS s, read_number FROM fastq_files WHERE NOT is_index AND NOT (read_number = 2 AND lane = 4))
SELECT a.s || '.r1.fastq' AS r1, CASE WHEN b.s IS NOT NULL THEN b.s || '.r2.fastq' END AS r2 FROM (SELECT s FROM f WHERE read_number = 1) a LEFT JOIN (SELECT s FROM f WHERE read_number = 2) b ON a.s = b.s""")
def x02_other_extractor(files):
    """Pairs of files whose names are of another kind, by an extractor of their own
    that gives a struct."""
    kept = files.filter("NOT is_index AND NOT (read_number = 2 AND lane = 4)")
    name = F.concat("project", F.lit("."), "sample", F.col("lane").cast("string"), F.lit(".r"), F.col("read_number").cast("string"), F.lit(".fastq"))

    def dotted(path):
        a = N.dotted_attrs(path)
        none = {k: F.lit(None).cast("int") for k in ("sample_number", "lane_number", "set_number")}
        return F.struct(*[c.alias(k) for k, c in (a | none | {"is_index_read": F.lit(False)}).items()])

    return P.pairs_by_name(kept.select(name.alias("fastq")).distinct(), dotted)


# Pairing -------------------------------------------------------------------------


@query("fastq_files", sql="""WITH f AS (SELECT read_number, project || '/' || fastq AS path, project || '/' || replace(replace(fastq, '_R2_', '_R1_'), '.fastq.gz', '') AS stem FROM fastq_files WHERE NOT is_index AND NOT (read_number = 2 AND lane = 4))
SELECT a.path AS r1, b.path AS r2 FROM (SELECT * FROM f WHERE read_number = 1) a FULL JOIN (SELECT * FROM f WHERE read_number = 2) b ON a.stem = b.stem""")
def j12_pair_by_name(files):
    kept = files.filter("NOT (read_number = 2 AND lane = 4)")
    return P.pairs_by_name(kept.withColumn("fastq", F.concat_ws("/", "project", "fastq")))


@query("reads", sql="""WITH firsts AS (
  SELECT project || '/' || sample || '/' || CAST(lane AS VARCHAR) AS unit, lane, name_key FROM (
    SELECT project, sample, lane, CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR) || ':' || CAST(l_partkey AS VARCHAR) AS name_key,
      row_number() OVER (PARTITION BY project, sample, lane ORDER BY l_orderkey, l_linenumber, l_partkey) AS k FROM reads) t WHERE k = 1)
SELECT a.unit || '/R1' AS r1, b.unit || '/R2' AS r2 FROM firsts a LEFT JOIN (SELECT * FROM firsts WHERE lane <> 4) b ON a.name_key = b.name_key""")
def j13_pair_by_header(reads):
    """Each unit has a file of first and, but for lane 4, one of second reads."""
    both = reads.withColumn("read_number", F.explode(F.array(F.lit(1), F.lit(2)))).filter("NOT (read_number = 2 AND lane = 4)")
    return P.pairs_by_header(
        both.select(
            F.concat_ws("/", "project", "sample", F.col("lane").cast("string"), F.concat(F.lit("R"), F.col("read_number").cast("string"))).alias("file"),
            F.struct("l_orderkey", "l_linenumber", "l_partkey").alias("read_idx"),
            F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey").alias("name_key"), "read_number",
        )
    )


@query("fastq_files", sql="""SELECT replace(replace(replace(fastq, '_R2_', '_R1_'), '_I1_', '_R1_'), '.fastq.gz', '') AS stem, string_agg(CAST(is_index AS VARCHAR) || ':' || read_number || ':' || fastq, ',' ORDER BY is_index, read_number, fastq) AS files FROM fastq_files GROUP BY 1""")
def j14_group_sets(files):
    listed = F.transform("files", lambda x: F.concat_ws(":", x["index"].cast("string"), x["read"].cast("string"), x["fastq"]))
    return P.sets_of_files(files).select("stem", F.array_join(listed, ",").alias("files"))


@query("fastq_files", sql="SELECT min(project || '/' || fastq) AS fastq FROM fastq_files WHERE NOT is_index AND read_number = 1 GROUP BY project, sample, lane")
def u05_representatives(files):
    kept = files.withColumn("fastq", F.concat_ws("/", "project", "fastq"))
    return P.representatives(kept).select("fastq")


@query("fastq_files", sql=r"SELECT regexp_replace(replace(fastq, '.fastq.gz', ''), '_L00[0-9]', '') AS merged, count(*) AS n_files, CAST(sum(n_reads) AS BIGINT) AS n_reads FROM fastq_files GROUP BY 1")
def u02_merged_files(files):
    return P.merged_lanes(files)


#: Outputs of every file, of reads 2, and of reads that there are none of; index files have none.
QC_RULES = [("pages", ".html", None), ("pages", "_data.txt", None), ("screen", "_screen.txt", (2,)), ("strand", "_strand.txt", (4,))]
QC_SQL = """WITH f AS (SELECT DISTINCT fastq, read_number, is_index FROM fastq_files),
e AS (SELECT r.module, fastq, r.suffix, (length(fastq) + length(r.suffix)) % 5 > 0 AS there FROM f, (SELECT unnest([{'module': 'pages', 'suffix': '.html', 'read': 0},
 {'module': 'pages', 'suffix': '_data.txt', 'read': 0}, {'module': 'screen', 'suffix': '_screen.txt', 'read': 2}]) AS r) s WHERE NOT is_index AND (r.read = 0 OR r.read = read_number))"""


def _qc(files):
    files = files.select("fastq").distinct()
    expected = P.expected_outputs(files, QC_RULES)
    return files, expected, expected.filter((F.length("fastq") + F.length("suffix")) % 5 > 0).select("fastq", "suffix")


@query("fastq_files", sql=f"""{QC_SQL} SELECT f.fastq, count(e.suffix) AS n_expected, count(e.suffix) FILTER (NOT there) AS n_missing,
 CASE WHEN count(e.suffix) > 0 THEN count(e.suffix) FILTER (NOT there) = 0 END AS ok FROM f LEFT JOIN e ON e.fastq = f.fastq GROUP BY f.fastq""")
def j16_qc_completeness(files):
    return P.completeness(*_qc(files))


@query("fastq_files", sql=f"""{QC_SQL}, m AS (SELECT m.module, count(e.suffix) AS n_expected, count(e.suffix) FILTER (NOT there) AS n_missing
 FROM (SELECT unnest(['pages', 'screen', 'strand']) AS module) m LEFT JOIN e ON e.module = m.module GROUP BY m.module)
SELECT module, n_expected, n_missing, CASE WHEN n_expected > 0 THEN n_missing = 0 END AS ok FROM m
UNION ALL SELECT NULL, sum(n_expected), sum(n_missing), sum(n_missing) = 0 FROM m""", longs="n_expected n_missing")
def j16_qc_verdict(files):
    _, expected, present = _qc(files)
    modules = files.sparkSession.createDataFrame([(m,) for m in dict.fromkeys(r[0] for r in QC_RULES)], "module string")
    return P.verdict(modules, expected, present)


@query("sample_sheet", "fastq_files", sql="SELECT DISTINCT s.project, s.sample FROM sample_sheet s WHERE CAST(substr(s.sample, 2) AS INT) % 4 = 3 OR NOT EXISTS (SELECT 1 FROM fastq_files f WHERE f.project = s.project AND f.sample = s.sample)")
def j19_missing_outputs(sheet, files):
    """Some samples' files are not there."""
    there = files.filter(F.coalesce(F.substring("sample", 2, 9).try_cast("int"), F.lit(0)) % 4 != 3)
    return P.missing(sheet.select("project", "sample").distinct(), there, ["project", "sample"])


TREES = "CASE WHEN lane = 3 AND project IN ('P1', 'P2', 'Undetermined_indices') THEN 'x' WHEN lane = 4 AND project IN ('P2', 'Undetermined_indices') THEN 'y' WHEN lane < 3 THEN 'primary' END"
TREED = f"(SELECT project, CASE WHEN project = 'Undetermined_indices' THEN 'u' || CAST(lane % 2 AS VARCHAR) ELSE sample END AS sample, {TREES} AS tree, fastq FROM fastq_files) t"


def _trees(files):
    """Two extra trees, x and y. P1 is in one of them, P2 in both, P0 in none."""
    made = F.expr(TREES.replace("VARCHAR", "STRING")).alias("tree")
    sample = F.when(F.col("project") == S.UNDETERMINED, F.concat(F.lit("u"), (F.col("lane") % 2).cast("string"))).otherwise(F.col("sample"))
    treed = files.select("project", sample.alias("sample"), made, "fastq")
    return treed.filter("tree = 'primary'"), treed.filter("tree IN ('x', 'y')")


@query("fastq_files", sql=f"""SELECT project, sample, tree, fastq FROM {TREED} WHERE (project = 'P0' AND tree = 'primary') OR (project = 'P1' AND tree = 'x') OR (project = 'Undetermined_indices' AND tree IN ('x', 'y'))""")
def u04_merge_trees(files):
    """P2 is a conflict. Undetermined samples: u1 is in x, u0 in y; the primary ones go."""
    return P.merge_trees(*_trees(files))[0]


@query("fastq_files", sql=f"""SELECT project, sample, tree, fastq FROM {TREED} WHERE (project = 'P0' AND tree = 'primary') OR (project = 'P1' AND tree = 'x') OR (project = 'Undetermined_indices' AND tree IS NOT NULL)""")
def u04_concatenated(files):
    """Lanes are not split: all undetermined reads are kept."""
    return P.merge_trees(*_trees(files), lanes_split=False)[0]


@query("fastq_files", sql=f"""SELECT tree, lane IS NOT NULL AS has_lanes, count(*) AS n_files FROM (SELECT *, {TREES} AS tree FROM (SELECT project, fastq, lane FROM fastq_files) f) t WHERE tree IN ('x', 'y') AND tree = 'x' GROUP BY ALL
UNION ALL SELECT 'y', FALSE, count(*) FROM {TREED} WHERE tree = 'y' HAVING count(*) > 0""")
def u04_mixed_formats(files):
    """The names of tree y have no lanes."""
    bare = F.when(F.col("tree") == "y", F.regexp_replace("fastq", "_L00[0-9]", "")).otherwise(F.col("fastq"))
    return P.mixed_formats(_trees(files)[1].withColumn("fastq", bare))


@query("fastq_files", sql=f"SELECT project, CAST(NULL AS VARCHAR) AS sample, count(DISTINCT tree) AS n_trees FROM {TREED} WHERE tree IN ('x', 'y') AND project <> 'Undetermined_indices' GROUP BY project HAVING count(DISTINCT tree) > 1")
def u04_conflicts(files):
    return P.merge_trees(*_trees(files))[1]


# Registry ------------------------------------------------------------------------

LINED = "(SELECT *, row_number() OVER (ORDER BY lane, CAST(substr(sample, 2) AS INT)) AS line_no FROM sample_sheet) s"


def _lined(sheet):
    return sheet.withColumn("line_no", F.col("lane") * 1000 + F.substring("sample", 2, 9).cast("int"))


@query("sample_sheet", sql="SELECT lane, sample, CASE WHEN lane IN (1, 2) AND regexp_matches(sample, '^S1.*$') THEN 'new' ELSE project END AS project, index_seq FROM sample_sheet")
def p08_set_column(sheet):
    return R.set_where(sheet, "project", F.lit("new"), (1, 2), ("sample", "S1*"))


@query("sample_sheet", sql="SELECT lane, sample FROM sample_sheet WHERE CAST(substr(sample, 2) AS INT) % 5 = 4 OR CAST(substr(sample, 2) AS INT) % 7 = 3")
def p09_incomplete(sheet):
    number = F.substring("sample", 2, 9).cast("int")
    holes = _lined(sheet).withColumns({"project": F.when(number % 5 == 4, F.lit(" ")).otherwise(F.col("project")), "sample_name": F.when(number % 7 != 3, F.col("sample"))})
    return R.incomplete(holes).select("lane", "sample")


@query("sample_sheet", sql="SELECT lane, sample FROM sample_sheet WHERE CAST(substr(sample, 2) AS INT) % 4 = 1")
def p10_bad_barcodes(sheet):
    made = sheet.withColumn("index_seq", F.when(F.substring("sample", 2, 9).cast("int") % 4 == 1, F.concat("index_seq", F.lit("+NNX"))).otherwise(F.col("index_seq")))
    return R.bad_barcodes(made).select("lane", "sample")


@query("registry", sql="""SELECT project, item FROM (SELECT project, disabled, unnest(['user_name', 'pi', 'organism', 'library']) AS item, unnest([user_name, pi, organism, library]) AS v FROM registry) t
 WHERE NOT disabled AND coalesce(trim(v), '.') IN ('.', '')""")
def p11_missing_metadata(registry):
    return R.missing_metadata(registry)


@query("registry", sql="SELECT project, pi FROM registry WHERE regexp_matches(pi, '^PI[12]$') OR pi IS NULL")
def p12_projects_by_pi(registry):
    return R.matching(registry, "pi", "PI[12]").unionByName(R.matching(registry, "pi", None)).select("project", "pi")


@query("registry", sql="SELECT project FROM registry WHERE regexp_matches(project, '^P1.*$')")
def p13_projects_by_glob(registry):
    return R.matching(registry, "project", "P1*").select("project")


@query("orders", sql=f"""WITH r AS (SELECT o_orderkey, run, facility, 'MISEQ_' || split_part(run, '_', 1) || CASE WHEN number <> facility THEN '/' || number ELSE '' END || '#' || facility AS id FROM {RUNS}),
one AS (SELECT * FROM r ORDER BY o_orderkey LIMIT 1)
SELECT r.o_orderkey, r.run = one.run AS by_run, r.id = one.id AS by_id, r.o_orderkey = one.o_orderkey AS by_name, TRUE AS any_run FROM r, one""")
def p13_runs_by_reference(orders):
    """Which runs the first run's name, ID and directory mean, and which `*` does."""
    runs = _runs(orders).select(
        "o_orderkey", F.concat(F.lit("/data/"), "run", F.lit("_analysis"), F.col("o_orderkey").cast("string")).alias("path"), F.col("run").alias("run_name"),
        F.lit("miseq").alias("platform"), F.col("facility").alias("run_number"), F.lit(None).cast("int").alias("analysis_number"),
    )
    first = runs.orderBy("o_orderkey").first()
    id_ = runs.limit(1).select(N.run_id(F.lit(first.run_name), F.lit("miseq"), F.lit(first.run_number), F.lit(None).cast("int"))).first()[0]
    names = {"by_run": first.run_name, "by_id": id_, "by_name": first.path.rpartition("/")[2], "any_run": "*"}
    out = runs.select("o_orderkey")
    for name, wanted in names.items():
        out = out.join(R.matching_runs(runs, wanted).select("o_orderkey", F.lit(True).alias(name)), "o_orderkey", "left")
    return out.select("o_orderkey", *[F.coalesce(n, F.lit(False)).alias(n) for n in names])


@query("sample_sheet", sql="""WITH l AS (SELECT DISTINCT sample, project, CAST(substr(sample, 2) AS INT) AS k FROM sample_sheet)
SELECT sample, CASE WHEN k % 3 = 0 THEN 'R#2' WHEN k % 3 = 1 THEN 'R#1' END AS run, project, CASE WHEN k % 2 = 0 THEN sample ELSE 'X' || sample END AS linked_sample, k % 2 = 0 AND k % 3 <> 0 AS known FROM l""")
def j17_linked_samples(sheet):
    """Samples of run R#1, and of the run at hand, are known; those of R#2 are not."""
    k = F.substring("sample", 2, 9).cast("int")
    linked = F.when(k % 2 == 0, F.col("sample")).otherwise(F.concat(F.lit("X"), "sample"))
    run = F.when(k % 3 == 0, "R#2:").when(k % 3 == 1, "R#1:").otherwise(":")
    links = sheet.select("sample", F.concat(run, "project", F.lit("/"), linked).alias("reference")).distinct()
    known = sheet.withColumn("run", F.explode(F.array(F.lit("R#1"), F.lit(None).cast("string"))))
    return R.linked(links, known)


@query("registry", "fastq_files", sql="""WITH o AS (SELECT project, string_agg(DISTINCT sample, ',' ORDER BY sample) AS s FROM fastq_files GROUP BY project)
SELECT coalesce(r.project, o.project) AS project, coalesce(o.s, CASE WHEN r.project IS NOT NULL THEN 'old' END) AS samples, o.project IS NULL AS disabled FROM registry r FULL JOIN o ON o.project = r.project""")
def j18_refreshed_table(registry, files):
    found = files.groupBy("project").agg(F.array_join(F.array_sort(F.collect_set("sample")), ",").alias("samples"))
    return R.refreshed(registry.select("project", F.lit("old").alias("samples"), "disabled"), found)


@query("sample_sheet", sql="SELECT project, sample, string_agg(index_seq, ',' ORDER BY index_seq) AS found FROM (SELECT DISTINCT project, sample, CASE WHEN lane = 4 AND sample = 'S3' THEN 'AAAA' ELSE index_seq END AS index_seq FROM sample_sheet) t GROUP BY ALL HAVING count(*) > 1")
def a24_multi_barcode(sheet):
    made = sheet.withColumn("index_seq", F.when((F.col("lane") == 4) & (F.col("sample") == "S3"), "AAAA").otherwise(F.col("index_seq")))
    return R.several(made, "index_seq", ("project", "sample")).withColumn("found", F.array_join("found", ","))


@query("sample_sheet", sql="SELECT sample, string_agg(project, ',' ORDER BY project) AS found FROM (SELECT DISTINCT sample, CASE WHEN lane = 2 AND sample < 'S15' THEN 'Px' ELSE project END AS project FROM sample_sheet) t GROUP BY ALL HAVING count(*) > 1")
def a25_multi_project(sheet):
    made = sheet.withColumn("project", F.when((F.col("lane") == 2) & (F.col("sample") < "S15"), "Px").otherwise(F.col("project")))
    return R.several(made, "project", ("sample",)).withColumn("found", F.array_join("found", ","))


@query("sample_sheet", sql=f"""WITH n AS (SELECT sample, row_number() OVER (ORDER BY min(line_no), sample) AS sample_number FROM {LINED} GROUP BY sample)
SELECT project, s.sample, index_seq, string_agg(DISTINCT CAST(lane AS VARCHAR), ',' ORDER BY CAST(lane AS VARCHAR)) AS lanes, any_value(n.sample_number) AS sample_number FROM sample_sheet s JOIN n ON n.sample = s.sample GROUP BY project, s.sample, index_seq""", ints="sample_number")
def a26_predict_outputs(sheet):
    return R.predicted_outputs(_lined(sheet))


@query("sample_sheet", sql="SELECT project, lane, count(DISTINCT sample) AS n_samples, min(repeat('N', length(index_seq))) AS index_shape, count(DISTINCT length(index_seq)) > 1 AS mixed FROM sample_sheet GROUP BY project, lane")
def a27_lane_shapes(sheet):
    return R.summary_by_lane(sheet)


@query("registry", sql="""WITH p AS (SELECT a.project, b.project AS "close", 1 - levenshtein(a.project, b.project) * 1.0 / greatest(length(a.project), length(b.project)) AS likeness FROM registry a JOIN registry b ON a.project <> b.project)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY project ORDER BY likeness DESC, "close") AS rank FROM p WHERE likeness >= 0.6) t WHERE rank <= 3""", ints="rank")
def a28_close_names(registry):
    return R.close_names(registry)


FAULTY = """(SELECT lane, sample, lane * 1000 + k AS line_no, CASE WHEN k % 5 = 4 THEN ' ' WHEN lane = 2 AND k % 7 = 1 THEN 'Px' ELSE project END AS project,
 CASE WHEN lane = 4 AND k % 6 = 3 THEN 'AAAA' WHEN k % 4 = 1 THEN index_seq || '+NNX' WHEN k % 9 = 2 THEN index_seq || chr(233) ELSE index_seq END AS index_seq FROM (SELECT *, CAST(substr(sample, 2) AS INT) AS k FROM sample_sheet) n)"""


@query("sample_sheet", sql=f"""WITH s AS (SELECT * FROM {FAULTY} f), p AS (SELECT DISTINCT project FROM s),
close_ AS (SELECT a.project, count(*) AS n FROM p a JOIN p b ON a.project <> b.project WHERE 1 - levenshtein(a.project, b.project) * 1.0 / greatest(length(a.project), length(b.project)) >= 0.5 GROUP BY a.project)
SELECT 'several_barcodes' AS "check", count(*) AS n_found FROM (SELECT 1 FROM s GROUP BY project, sample HAVING count(DISTINCT index_seq) > 1) t
UNION ALL SELECT 'several_projects', count(*) FROM (SELECT 1 FROM s GROUP BY sample HAVING count(DISTINCT project) > 1) t
UNION ALL SELECT 'close_names', coalesce(sum(least(n, 3)), 0) FROM close_
UNION ALL SELECT 'incomplete', count(*) FROM s WHERE trim(project) = ''
UNION ALL SELECT 'bad_barcodes', count(*) FROM s WHERE regexp_matches(index_seq, '[^ATGC+]')
UNION ALL SELECT 'bad_characters', count(*) FROM s WHERE regexp_matches(index_seq, '[^\x20-\x7F]')""", longs="n_found")
def a29_lint(sheet):
    k = F.substring("sample", 2, 9).cast("int")
    faulty = _lined(sheet).withColumns(
        {
            "project": F.when(k % 5 == 4, " ").when((F.col("lane") == 2) & (k % 7 == 1), "Px").otherwise(F.col("project")),
            "index_seq": F.when((F.col("lane") == 4) & (k % 6 == 3), "AAAA").when(k % 4 == 1, F.concat("index_seq", F.lit("+NNX"))).when(k % 9 == 2, F.concat("index_seq", F.lit(chr(233)))).otherwise(F.col("index_seq")),
        }
    )
    return R.lint(faulty, 0.5)


@query("fastq_files", sql="""WITH p AS (SELECT project, sample, count(*) AS n FROM (SELECT DISTINCT project, sample, lane FROM fastq_files) t GROUP BY ALL)
SELECT project, count(*) AS n_samples, string_agg(sample, ', ' ORDER BY length(sample), sample) AS samples, max(n) > 1 AS several_files FROM p GROUP BY project""")
def a23_sample_summary(files):
    return R.sample_summary(files)


@query("cell_metrics", sql="SELECT project, CASE WHEN bool_and(value % 101 <> 0) THEN CAST(sum(value) AS BIGINT) END AS cells FROM cell_metrics GROUP BY project")
def a18_project_cells(metrics):
    """Some samples have no number of cells, so their projects have none."""
    return R.cell_counts(metrics.withColumn("metric", F.when(F.col("value") % 101 == 0, "Other").otherwise(F.col("metric"))))


ALIASES = [("cells", "Estimated Number of Cells", 1), ("cells", "Estimated number of cells", 2), ("cells", "annotated_cells", 3)]


@query("cell_metrics", sql="SELECT project, sample, 'cells' AS canonical, CASE WHEN metric IN ('Estimated Number of Cells', 'Estimated number of cells') THEN value WHEN metric = 'Cells' THEN value + 1 ELSE least(value, value + 1) END AS value FROM cell_metrics WHERE metric <> 'annotated_cells' UNION ALL SELECT project, sample, 'cells', value FROM cell_metrics WHERE metric = 'annotated_cells'")
def a19_metric_alias(metrics):
    """Every sample but those that have it has a second name of the metric, one more."""
    second = metrics.filter("metric <> 'annotated_cells'").select("project", "sample", F.lit("annotated_cells").alias("metric"), (F.col("value") + 1).alias("value"))
    aliases = metrics.sparkSession.createDataFrame(ALIASES, "canonical string, metric string, priority int")
    return R.by_alias(metrics.unionByName(second), aliases)


@query("cell_metrics", sql="SELECT sample, CAST(CASE WHEN value % 3 <> 0 THEN value * CAST(1000 AS DOUBLE) / (value % 3) ELSE value END AS DOUBLE) AS reads_per_cell FROM cell_metrics")
def a20_reads_per_cell(metrics):
    v = F.col("value").cast("double")
    rows = metrics.select("sample", (v * 1000).alias("reads_in_cells"), (v % 3).alias("cells"), v.alias("mean_reads"), F.lit(None).cast("double").alias("median_reads"))
    return R.reads_per_cell(rows).select("sample", "reads_per_cell")


@query("cell_metrics", sql="SELECT project AS file, CAST(arg_min(value, sample) AS DOUBLE) AS value FROM cell_metrics WHERE metric = 'Cells' GROUP BY project")
def a21_metric_by_type(metrics):
    rows = metrics.select(F.col("project").alias("file"), "metric", F.lit("Gene Expression").alias("library_type"), F.col("sample").alias("line_no"), F.col("value").cast("double").alias("value"))
    return qc.metric_by_type(rows, "Cells")


@query("registry", "fastq_files", "cell_metrics", sql="""WITH s AS (SELECT project, count(DISTINCT sample) AS n, string_agg(DISTINCT sample, ', ') AS x FROM fastq_files GROUP BY project), c AS (SELECT project, sum(value) AS cells FROM cell_metrics GROUP BY project),
o AS (SELECT project, string_agg(sample, ', ' ORDER BY length(sample), sample) AS samples FROM (SELECT DISTINCT project, sample FROM fastq_files) d GROUP BY project)
SELECT r.project, user_name, pi, CASE WHEN r.project = 'P2' THEN '7' ELSE coalesce(CAST(s.n AS VARCHAR), '?') END AS n_samples, CAST(c.cells AS BIGINT) AS cells, CASE WHEN s.n IS NULL THEN '?' WHEN r.project = 'P1' THEN 'SE' ELSE 'PE' END AS ends,
 concat_ws('/', organism, library) AS kind, coalesce(o.samples, '') AS samples FROM registry r LEFT JOIN s ON s.project = r.project LEFT JOIN c ON c.project = r.project LEFT JOIN o ON o.project = r.project""")
def a30_project_report(registry, files, metrics):
    """P1 has no second reads; P2's libraries are multiplexed."""
    ends = R.paired_end(files.filter("NOT (project = 'P1' AND read_number = 2)"))
    multiplexed = registry.sparkSession.createDataFrame([("P2", 7)], "project string, n_multiplexed long")
    return R.project_report(registry, R.sample_summary(files), R.cell_counts(metrics), ends, multiplexed)


@query("fastq_files", sql="SELECT project, count(DISTINCT sample) AS n_samples, count(DISTINCT read_number * 2 + CAST(is_index AS INT)) AS n_read_kinds, count(DISTINCT lane) AS n_lanes, count(*) AS n_files, CAST(sum(n_reads) AS BIGINT) AS n_reads FROM fastq_files GROUP BY project")
def a31_census(files):
    return R.census(files)


@query("fastq_files", sql="""WITH f AS (SELECT DISTINCT project, sample, CASE WHEN is_index THEN 'i' ELSE 'r' END || CAST(read_number AS VARCHAR) AS read FROM fastq_files),
o AS (SELECT DISTINCT project, CASE WHEN lane < 3 THEN 'screen' ELSE 'lengths' END AS kind, CASE WHEN lane = 1 THEN 'human' WHEN lane = 2 THEN 'mouse' END AS organism, CASE WHEN lane < 3 THEN 'model' || CAST(lane AS VARCHAR) END AS screen FROM fastq_files)
SELECT s.project, samples, reads, outputs, organisms, screens FROM (SELECT project, string_agg(sample, ',' ORDER BY length(sample), sample) AS samples FROM (SELECT DISTINCT project, sample FROM f) a GROUP BY project) s
JOIN (SELECT project, string_agg(DISTINCT read, ',' ORDER BY read) AS reads FROM f GROUP BY project) r ON r.project = s.project
JOIN (SELECT project, string_agg(DISTINCT kind, ',' ORDER BY kind) AS outputs, string_agg(DISTINCT organism, ',' ORDER BY organism) AS organisms, string_agg(DISTINCT screen, ',' ORDER BY screen) AS screens FROM o GROUP BY project) k ON k.project = s.project""")
def a31_qc_census(files):
    lane = F.col("lane")
    outputs = files.select(
        "project", F.when(lane < 3, "screen").otherwise("lengths").alias("kind"), F.when(lane == 1, "human").when(lane == 2, "mouse").alias("organism"),
        F.when(lane < 3, F.concat(F.lit("model"), lane.cast("string"))).alias("screen"),
    )
    names = ("samples", "reads", "outputs", "organisms", "screens")
    return R.qc_census(files, outputs).select("project", *[F.array_join(c, ",").alias(c) for c in names])


@query("sample_sheet", sql="SELECT project, string_agg(DISTINCT sample, ',' ORDER BY sample) AS samples FROM sample_sheet WHERE project <> 'P1' OR sample LIKE 'S1%' GROUP BY project")
def a32_biological_samples(sheet):
    listed = F.array_sort(F.collect_set(F.when((F.col("project") == "P1") & F.col("sample").startswith("S1"), F.col("sample"))))
    rows = sheet.groupBy("project").agg(listed.alias("listed"), F.array().cast("array<string>").alias("by_library"), F.collect_set("sample").alias("all"))
    return R.biological_samples(rows).withColumn("samples", F.array_join("samples", ","))


@query("sample_sheet", sql="""SELECT project AS config, 'duplicate_sample' AS "check", sample AS value FROM sample_sheet GROUP BY project, sample HAVING count(*) > 1
UNION ALL SELECT project, 'duplicate_tag', index_seq FROM sample_sheet GROUP BY project, index_seq HAVING count(*) > 1
UNION ALL SELECT project, 'duplicate_type', 't' || CAST(lane AS VARCHAR) FROM sample_sheet WHERE lane < 4 GROUP BY project, lane HAVING count(*) > 1
UNION ALL SELECT DISTINCT project, 'unknown_type', 'T4' FROM sample_sheet""")
def a33_library_checks(sheet):
    rows = sheet.select(F.col("project").alias("config"), "sample", F.col("index_seq").alias("tag"), F.concat(F.lit("T"), F.col("lane").cast("string")).alias("feature_type"))
    return R.library_checks(rows, sheet.sparkSession.createDataFrame([("T1",), ("T2",), ("T3",)], "feature_type string"))


@query("part", sql="SELECT package, string_agg(DISTINCT v, ',' ORDER BY v) AS versions FROM (SELECT 'p' || (p_partkey % 9) AS package, CAST(p_partkey % 4 AS VARCHAR) || '.' || CAST(p_partkey % 3 AS VARCHAR) AS v FROM part) t GROUP BY package")
def a39_software_versions(part):
    k = F.col("p_partkey")
    rows = part.select(F.concat(F.lit("p"), (k % 9).cast("string")).alias("package"), F.concat_ws(".", (k % 4).cast("string"), (k % 3).cast("string")).alias("version"))
    return R.software(rows.filter("package < 'p5'"), rows)


@query("fastq_files", sql="""WITH s AS (SELECT project, sample, max(read_number = 2 AND NOT (project = 'P1' AND sample = 'S1')) AS paired FROM fastq_files WHERE NOT is_index GROUP BY ALL)
SELECT project, bool_and(paired) AS paired_end FROM s GROUP BY ROLLUP (project)""")
def a40_paired_end(files):
    return R.paired_end(files.filter("NOT (project = 'P1' AND sample = 'S1' AND read_number = 2 AND NOT is_index)"))


@query("registry", sql="SELECT unnest(['pi', 'organism']) AS item, project, unnest([CASE WHEN disabled THEN 'q' ELSE coalesce(pi, 'run') END, organism]) AS value FROM registry")
def a41_metadata_table(registry):
    checked = registry.filter("disabled").select("project", F.lit("q").alias("pi"), F.lit(None).cast("string").alias("organism"))
    run = registry.sparkSession.createDataFrame([("run", "run")], "pi string, organism string")
    return R.metadata_table(registry, checked, run, ("pi", "organism"))


@query("sample_sheet", sql=f"SELECT sample, row_number() OVER (ORDER BY min(line_no), sample) AS sample_number FROM {LINED} GROUP BY sample", ints="sample_number")
def w05_sample_numbers(sheet):
    return tables.sheet_numbers(_lined(sheet))


# Sources and sinks: texts made from the tables, written, read back ------------------


def _named_reads(reads):
    key = F.concat_ws(":", F.lit("@M1:7:FC"), F.col("lane").cast("string"), F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.lit("1"))
    return reads.withColumn("header", F.concat(key, F.lit(" 1:N:0:"), "barcode"))


def _landed(reads, name: str) -> str:
    path = shared.new_folder(reads.sparkSession, name)
    fastq.as_text(_named_reads(reads)).write.text(path)
    return path


@query("reads", sql="SELECT lane, 1 AS read_number, barcode, sequence, quality FROM reads")
def s01_read_fastq(reads):
    path = _landed(reads, "fastq")
    return fastq.read_fastq(reads.sparkSession, path, "part-*").select("lane", "read_number", "barcode", "sequence", "quality")


@query("reads", sql="SELECT lane, count(*) AS n, count(DISTINCT name_key) AS n_names FROM (SELECT lane, l_orderkey || ':' || l_linenumber AS name_key FROM reads) t GROUP BY lane")
def e28_header_fields(reads):
    p = fastq.header_parts(F.col("header"))
    made = _named_reads(reads).drop("lane").select(p["lane"].alias("lane"), p["name_key"].alias("name_key"))
    return made.groupBy("lane").agg(F.count("*").alias("n"), F.countDistinct("name_key").alias("n_names"))


@query("reads", sql=COUNTS)
def s02_s03_counts_file(reads):
    path = shared.new_folder(reads.sparkSession, "counts")
    tables.counts_lines(C.ranked(C.counts(reads))).write.text(path)
    return tables.read_counts(reads.sparkSession, path).filter("error IS NULL").select("lane", "barcode", "n")


@query("sample_sheet", sql="SELECT lane, sample, project, substr(index_seq, 1, 4) || CASE WHEN lane > 1 THEN '+' || substr(index_seq, 5) ELSE '' END AS index_seq FROM sample_sheet")
def s04_sample_sheet(sheet):
    """A sheet with sections, written as one file: lane 2's samples have one index with
    a dash, others two, or one alone; projects are quoted, as descriptions with commas are."""
    one = F.substring("index_seq", 1, 4)
    first = F.when(F.col("lane") == 2, F.concat_ws("-", one, F.substring("index_seq", 5, 9))).otherwise(one)
    second = F.when(F.col("lane") > 2, F.substring("index_seq", 5, 9)).otherwise(F.lit(""))
    rows = sheet.select(F.concat_ws(",", F.col("lane").cast("string"), F.col("sample"), F.lit('"a, ""b"" c"'), F.concat(F.lit('"'), "project", F.lit('"')), first, second).alias("value"))
    text = rows.agg(F.concat_ws("\n", F.lit("[Header]"), F.lit("IEMFileVersion,4"), F.lit("[Data]"), F.lit("Lane,Sample_ID,Description,Sample_Project,index,index2"), F.array_join(F.array_sort(F.collect_list("value")), "\n")).alias("value"))
    path = shared.new_folder(sheet.sparkSession, "sheet")
    text.coalesce(1).write.text(path)
    return tables.read_sheet(sheet.sparkSession, path).select("lane", "sample", "project", "index_seq")


FASTQ_LINES = "'@M1:7:FC:' || lane || ':' || l_orderkey || ':' || l_linenumber || ':1 1:N:0:' || barcode || chr(10) || sequence || chr(10) || '+' || chr(10) || quality"
UNIT_ORDER = f"l_orderkey, l_linenumber, l_partkey, sequence, {FASTQ_LINES}"


@query("reads", sql=f"""SELECT project || '_' || sample || '_L00' || CAST(lane AS VARCHAR) || CASE WHEN lane = 4 THEN '_I1' ELSE '_R1' END AS unit, md5(string_agg({FASTQ_LINES}, chr(10) ORDER BY {UNIT_ORDER}) || chr(10)) AS md5,
 CASE WHEN lane < 4 THEN TRUE END AS ok, sum(strlen({FASTQ_LINES}) + 1) AS size_bytes, count(*) AS n_reads FROM reads GROUP BY project, sample, lane""", longs="size_bytes")
def s05_s19_s20_files(reads):
    """A file for each unit, lane 4's of index reads: listed, checked, summed up, read."""
    spark, path = reads.sparkSession, shared.new_folder(reads.sparkSession, "files")
    name = F.concat_ws("_", "project", "sample", F.concat(F.lit("L00"), F.col("lane").cast("string")), F.when(F.col("lane") == 4, "I1").otherwise("R1"))
    order = F.struct("l_orderkey", "l_linenumber", "l_partkey", "sequence", "value")
    rows = fastq.as_text(_named_reads(reads).withColumn("unit", name), "unit", "l_orderkey", "l_linenumber", "l_partkey", "sequence")
    texts = rows.groupBy("unit").agg(F.array_join(F.transform(F.array_sort(F.collect_list(order)), lambda x: x["value"]), "\n").alias("value"))
    texts.write.partitionBy("unit").text(path)
    unit = lambda c: F.regexp_extract(c, "unit=([^/]+)/", 1).alias("unit")
    # The check looks at base names, which are Spark's here: index files are told by their folders.
    files = fastq.inventory(spark, path, "part-*").select(unit("path"), "size_bytes")
    sums = fastq.checksums(spark, path, "part-*").select(unit("file"), "md5")
    checked = fastq.check_fastq(spark, path, "part-*").select(unit("file"), "ok").filter("unit NOT LIKE '%I1'")
    counted = fastq.read_fastq(spark, path, "part-*").groupBy(unit("file")).agg(F.count("*").alias("n_reads"))
    return files.join(sums, "unit").join(counted, "unit").join(checked, "unit", "left").select("unit", "md5", "ok", "size_bytes", "n_reads")


def _unit_files(reads, name: str) -> str:
    """A file for each unit, its reads in order; lane 2's are packed. Reads 2 of P1 besides."""
    path, both = shared.new_folder(reads.sparkSession, name), F.when(F.col("project") == "P1", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = _named_reads(reads).withColumn("number", F.explode(both))
    rows = rows.withColumns({"header": F.replace("header", F.lit(":1 1:N"), F.concat(F.lit(":"), F.col("l_partkey").cast("string"), F.lit(" "), F.col("number").cast("string"), F.lit(":N"))), "unit": F.concat_ws("_", *UNIT, "number")})
    rows = fastq.as_text(rows, "unit", "lane", "l_orderkey", "l_linenumber", "l_partkey", "sequence").repartition("unit").sortWithinPartitions("unit", "l_orderkey", "l_linenumber", "l_partkey", "sequence", "value")
    for packed in (False, True):
        part = rows.filter((F.col("lane") == 2) == packed).select("unit", "value")
        part.write.option("compression", "gzip" if packed else "none").partitionBy("unit").text(f"{path}/{packed}")
    return path


def _unit(c: str):
    return F.regexp_extract(c, "unit=([^/]+)/", 1)


UNIT_NAME = "project || '_' || sample || '_' || lane"


@query("reads", sql=f"""WITH n AS (SELECT project, {UNIT_NAME} AS unit, count(*) AS n_reads FROM reads GROUP BY ALL)
SELECT unit || '_1' AS unit, n_reads, TRUE AS whole FROM n UNION ALL SELECT unit || '_2', n_reads, TRUE FROM n WHERE project = 'P1'""")
def a03_counts_of_files(reads):
    """Reads of files by their line ends, a file read in many pieces."""
    path = _unit_files(reads, "counted")
    return fastq.count_reads(reads.sparkSession, path, "part-*", piece=1 << 16).select(_unit("file").alias("unit"), "n_reads", "whole")


@query("reads", sql=f"""WITH h AS (SELECT project, {UNIT_NAME} AS unit, sequence, row_number() OVER (PARTITION BY project, sample, lane ORDER BY l_orderkey, l_linenumber, l_partkey, sequence, {FASTQ_LINES}) - 1 AS read_idx FROM reads)
SELECT unit || '_1' AS unit, read_idx, sequence FROM h WHERE read_idx < 3 UNION ALL SELECT unit || '_2', read_idx, sequence FROM h WHERE read_idx < 3 AND project = 'P1'""")
def t04_heads(reads):
    """The first reads of each file, of which no more is read."""
    return fastq.read_fastq(reads.sparkSession, _unit_files(reads, "heads"), "part-*", limit=3).select(_unit("file").alias("unit"), "read_idx", "sequence")


@query("reads", sql=f"""WITH u AS (SELECT DISTINCT project, {UNIT_NAME} AS unit FROM reads) SELECT unit || '_1' AS unit, 1 AS read_number FROM u UNION ALL SELECT unit || '_2', 2 FROM u WHERE project = 'P1'""")
def t05_first_read_numbers(reads):
    first = fastq.heads(reads.sparkSession, _unit_files(reads, "first"), "part-*")
    return fastq.first_read_numbers(first).select(_unit("file").alias("unit"), "read_number")


@query("reads", sql=f"""WITH u AS (SELECT DISTINCT project, {UNIT_NAME} AS unit FROM reads) SELECT unit || '_1' AS r1, CASE WHEN project = 'P1' THEN unit || '_2' END AS r2 FROM u""")
def j13_pair_by_heads(reads):
    """Files whose first reads share their name, of which no more is read."""
    pairs = P.pairs_by_header(fastq.heads(reads.sparkSession, _unit_files(reads, "paired"), "part-*"))
    return pairs.select(_unit("r1").alias("r1"), F.nullif(_unit("r2"), F.lit("")).alias("r2"))


@query("reads", "sample_sheet", sql=f"""
WITH p AS (SELECT b.barcode, r.index_seq, {_apart('b.barcode', 'r.index_seq')} AS d FROM (SELECT DISTINCT barcode FROM reads) b CROSS JOIN ({REFS}) r),
m AS (SELECT barcode, min(index_seq) AS assigned FROM p WHERE d <= 1 GROUP BY barcode)
SELECT coalesce(m.assigned, 'undetermined') AS assigned, 1 AS read_number, count(*) AS n FROM reads LEFT JOIN m ON m.barcode = reads.barcode GROUP BY ALL""")
def s21_demultiplexed(reads, sheet):
    path = shared.new_folder(reads.sparkSession, "demultiplexed")
    fastq.write_demultiplexed(C.assign(reads, sheet, 1).withColumn("read_number", F.lit(1)), path)
    return reads.sparkSession.read.parquet(path).groupBy("assigned", "read_number").agg(F.count("*").alias("n"))


@query("reads", "sample_sheet", sql=f"""
WITH p AS (SELECT b.barcode, r.index_seq, {_apart('b.barcode', 'r.index_seq')} AS d FROM (SELECT DISTINCT barcode FROM reads) b CROSS JOIN ({REFS}) r),
m AS (SELECT barcode, min(index_seq) AS assigned FROM p WHERE d <= 1 GROUP BY barcode)
SELECT coalesce(m.assigned, 'undetermined') || '_R1' AS name, count(*) AS n, md5(string_agg({FASTQ_LINES.replace('barcode', 'reads.barcode')}, chr(10) ORDER BY {UNIT_ORDER.replace('barcode', 'reads.barcode')}) || chr(10)) AS md5
FROM reads LEFT JOIN m ON m.barcode = reads.barcode GROUP BY ALL""")
def s21_demultiplexed_fastq(reads, sheet):
    """Written as FASTQ and read back: the texts of each barcode's files, one after the other."""
    spark, path = reads.sparkSession, shared.new_folder(reads.sparkSession, "demultiplexed")
    named = C.assign(_named_reads(reads), sheet, 1).withColumn("read_number", F.lit(1))
    fastq.write_demultiplexed_fastq(named, path, order=["l_orderkey", "l_linenumber", "l_partkey", "sequence", "header", "quality"])
    name = F.regexp_extract("file", "([^/]+)_[0-9]+[.]fastq", 1).alias("name")
    counted = fastq.count_reads(spark, path, "*.fastq.gz").groupBy(name).agg(F.sum("n_reads").alias("n"))
    return counted.join(fastq.joined_checksums(spark, path, "*.fastq.gz", name), "name")


def _texts(rows: DataFrame, file, text) -> DataFrame:
    return rows.select(file.alias("file"), text.alias("text"))


def _lines(*parts) -> object:
    return F.concat_ws("\n", *[F.lit(p) if isinstance(p, str) else p for p in parts])


def _written(rows: DataFrame, file, text, name: str) -> str:
    """A file for each row; the row's name is in its path."""
    path = shared.new_folder(rows.sparkSession, name)
    text_sink.write_texts(_texts(rows, file, text), path)
    return path


def _of(path: str = "file"):
    return text_sink.name_of(F.col(path))


def _read(supplier, text, parser):
    """The outputs of a tool, a file for each supplier, written and read by a parser."""
    path = _written(supplier, F.concat(F.lit("f"), F.col("s_suppkey").cast("string")), text, "outputs")
    return qc.read(supplier.sparkSession, path, parser, "*.txt").withColumn("file", _of())


@query("reads", sql="""SELECT file, module, status, count(*) AS n_rows FROM (SELECT project || '_' || sample AS file, unnest(['Basic Statistics', 'Adapter Content', 'Adapter Content', 'Adapter Content']) AS module,
 unnest(['pass', 'warn', 'warn', 'warn']) AS status FROM (SELECT DISTINCT project, sample FROM reads) d) t GROUP BY ALL""")
def s06_fastqc_modules(reads):
    per = reads.groupBy("project", "sample").agg(F.count("*").alias("n"))
    text = _lines(
        "##FastQC\t0.11", ">>Basic Statistics\tpass", F.concat(F.lit("Total\t"), F.col("n").cast("string")), ">>END_MODULE",
        ">>Adapter Content\twarn", "#Position\tA\tB", "1\t0.5\t1.5", "2\t1.5\t2.5", ">>END_MODULE", "",
    )
    path = _written(per, F.concat_ws("_", "project", "sample"), text, "fastqc")
    found = qc.read(reads.sparkSession, path, qc.fastqc_modules, "*.txt")
    return found.groupBy(_of().alias("file"), "module", "status").agg(F.count("*").alias("n_rows"))


@query("supplier", sql="SELECT 'f' || s_suppkey AS file, CASE k WHEN 0 THEN 'Human' END AS library, CASE k WHEN 0 THEN 'Unmapped' ELSE 'Hit_no_libraries' END AS metric, CAST(CASE k WHEN 0 THEN 90 - s_suppkey ELSE s_suppkey + 0.5 END AS DOUBLE) AS value FROM supplier, (SELECT unnest([0, 1]) AS k) z")
def s08_screen_files(supplier):
    """The trailing line is a row without a library."""
    k = F.col("s_suppkey")
    text = _lines("#version: 0.4", "Genome\t%Unmapped", F.concat(F.lit("Human\t"), (90 - k).cast("string")), "", F.concat(F.lit("%Hit_no_libraries: "), (k + 0.5).cast("string")))
    return _read(supplier, text, qc.screen)


@query("supplier", sql="""SELECT 'f' || s_suppkey AS file, unnest(['metric', 'metric', 'histogram', 'histogram']) AS kind, unnest(['MEDIAN_INSERT_SIZE', 'MEAN_INSERT_SIZE', '10', '11']) AS name, unnest([CAST(140 AS DOUBLE), s_suppkey, 3, s_suppkey]) AS value FROM supplier""")
def s10_insert_size_files(supplier):
    k = F.col("s_suppkey").cast("string")
    text = _lines("## METRICS CLASS\tx", "MEDIAN_INSERT_SIZE\tMEAN_INSERT_SIZE", F.concat(F.lit("140\t"), k), "", "## HISTOGRAM\tint", "insert_size\tcount", "10\t3", F.concat(F.lit("11\t"), k))
    return _read(supplier, text, qc.insert_sizes)


@query("part", sql="SELECT 'f' || p_partkey AS file, unnest(['A', 'B']) AS adapter, unnest([CAST((p_partkey % 7 + 1.5) / 200 AS DOUBLE), CAST((p_partkey % 5 + 2.5) / 200 AS DOUBLE)]) AS content FROM part")
def a14_adapter_content(part):
    k = lambda m: (F.col("p_partkey") % m).cast("string")
    text = _lines(">>Adapter Content\tpass", "#Position\tA\tB", F.concat_ws("\t", F.lit("1"), k(7), k(5)), "2-3\t1.5\t2.5", ">>END_MODULE")
    return qc.adapter_content(qc.fastqc_modules(_texts(part, F.concat(F.lit("f"), F.col("p_partkey").cast("string")), text)))


@query("part", sql="SELECT 'f' || p_partkey AS file, CAST(p_partkey % 100 AS DOUBLE) AS percent, CASE WHEN p_partkey % 100 < 20 THEN 'fail' WHEN p_partkey % 100 < 30 THEN 'warn' ELSE 'pass' END AS verdict FROM part")
def a15_deduplicated(part):
    text = _lines(">>Sequence Duplication Levels\tpass", F.concat(F.lit("#Total Deduplicated Percentage\t"), (F.col("p_partkey") % 100).cast("string")), "1\t2\t3", ">>END_MODULE")
    return qc.deduplicated(qc.fastqc_modules(_texts(part, F.concat(F.lit("f"), F.col("p_partkey").cast("string")), text)))


@query("part", sql="SELECT 'f' || p_partkey AS file, CAST(p_partkey % 7 AS INT) AS mean, CAST(p_partkey % 5 AS INT) AS p90, '1' AS base FROM part")
def a13_base_quality_table(part):
    k = lambda m: F.concat((F.col("p_partkey") % m).cast("string"), F.lit(".9"))
    text = _lines(">>Per base sequence quality\tpass", "#Base\tMean", F.concat_ws("\t", F.lit("1"), k(7), *[F.lit("30.0")] * 4, k(5)), ">>END_MODULE")
    return qc.base_quality(qc.fastqc_modules(_texts(part, F.concat(F.lit("f"), F.col("p_partkey").cast("string")), text))).select("file", "base", "mean", "p90")


@query("supplier", sql="""SELECT file, status, string_agg(module, ',' ORDER BY module) AS modules FROM (SELECT 'f' || s_suppkey AS file, unnest(['PASS', CASE WHEN s_suppkey % 2 = 0 THEN 'PASS' ELSE 'WARN' END]) AS status, unnest(['One', 'Two']) AS module FROM supplier) t GROUP BY ALL""")
def s07_a16_summary(supplier):
    second = F.concat(F.when(F.col("s_suppkey") % 2 == 0, "PASS").otherwise("WARN"), F.lit("\tTwo\tx.fastq"))
    found = _read(supplier, _lines("PASS\tOne\tx.fastq", second), qc.fastqc_summary)
    return qc.modules_by_status(found).withColumn("modules", F.array_join("modules", ","))


@query("part", sql="""SELECT 'f' || p_partkey AS file, 'Human' AS library, CAST(p_partkey % 4 AS DOUBLE) AS mapped, CASE WHEN p_partkey % 4 > 2 THEN 'major' WHEN p_partkey % 4 > 0 THEN 'minor' END AS class FROM part""")
def s08_a17_screen(part):
    hit = F.concat_ws("\t", F.lit("Human"), F.lit("90"), (F.col("p_partkey") % 4).cast("string"), F.lit("0.00"), F.lit("0.00"), F.lit("0.00"))
    head = F.concat(
        F.when(F.col("p_partkey") % 2 == 0, "Library").otherwise("Genome"),
        F.lit("\t%Unmapped\t%One_hit_one_library\t%Multiple_hits_one_library\t%One_hit_multiple_libraries\t%Multiple_hits_multiple_libraries"),
    )
    texts = _texts(part, F.concat(F.lit("f"), F.col("p_partkey").cast("string")), _lines("#version: 0.4", head, hit, "", "%Hit_no_libraries: 5.0"))
    return qc.screen_classes(qc.screen(texts))


@query("supplier", sql="""SELECT 'f' || s_suppkey AS file, '0.1' AS version, 'Human' AS genome, CAST(s_suppkey % 90 AS DOUBLE) AS forward, CAST(10 AS DOUBLE) AS reverse, (s_suppkey % 90) / CAST(10 AS DOUBLE) AS ratio,
 CASE WHEN s_suppkey % 90 > 50 THEN 'forward' WHEN s_suppkey % 90 < 2 THEN 'reverse' ELSE 'unstranded?' END AS label FROM supplier""")
def s09_strand(supplier):
    text = _lines("#strand version: 0.1", "#Genome\t1st forward\t2nd reverse", F.concat(F.lit("Human\t"), (F.col("s_suppkey") % 90).cast("string"), F.lit("\t10.0")))
    return _read(supplier, text, qc.strand)


@query("part", sql="SELECT 'f' || p_partkey AS file, CAST(p_partkey % 300 AS DOUBLE) AS mean_insert_size, CAST(2.5 AS DOUBLE) AS standard_deviation, CAST(140 AS DOUBLE) AS median_insert_size, NULL::DOUBLE AS median_absolute_deviation FROM part")
def s10_s22_insert_sizes(part):
    values = F.concat(F.lit("140\t"), (F.col("p_partkey") % 300).cast("string"), F.lit("\t2.5"))
    text = _lines("## METRICS CLASS\tx", "MEDIAN_INSERT_SIZE\tMEAN_INSERT_SIZE\tSTANDARD_DEVIATION", values, "", "## HISTOGRAM\tint", "insert_size\tcount", "10\t3", "11\t4")
    return qc.collated_insert_sizes(qc.insert_sizes(_texts(part, F.concat(F.lit("f"), F.col("p_partkey").cast("string")), text)))


@query("supplier", sql="SELECT 'f' || s_suppkey AS file, 'Reads genomic origin' AS section, 'exonic' AS item, CAST(s_suppkey * 1000 + 5 AS DOUBLE) AS count, CAST(76.93 AS DOUBLE) AS percent FROM supplier")
def s11_rnaseq(supplier):
    text = _lines(">>>>>>> Input", "", ">>>>>>> Reads genomic origin", F.concat(F.lit("    exonic = "), F.col("s_suppkey").cast("string"), F.lit(",005 (76.93%)")))
    return _read(supplier, text, qc.rnaseq).drop("value_text")


@query("supplier", sql="SELECT 'f' || s_suppkey AS file, unnest([0, 1]) AS x, unnest([CAST(s_suppkey AS DOUBLE), 7.5]) AS y FROM supplier")
def s11_coverage_profile(supplier):
    text = _lines("#x\ty", "0.0\t1.0", F.concat(F.lit("0.9\t"), F.col("s_suppkey").cast("string")), "1.0\t7.5")
    return _read(supplier, text, qc.coverage_profile)


@query("supplier", sql="SELECT 'f' || s_suppkey AS file, TRUE AS paired, CAST(0.25 AS DOUBLE) AS forward, CAST(0.5 AS DOUBLE) AS reverse, CAST(0.25 AS DOUBLE) AS undetermined FROM supplier")
def s12_strand_inference(supplier):
    text = _lines("This is PairEnd Data", "Fraction of reads failed to determine: 0.25", 'Fraction of reads explained by "1++,1--,2+-,2-+": 0.25', 'Fraction of reads explained by "1+-,1-+,2++,2--": 0.5')
    return _read(supplier, text, qc.strand_inference)


@query("cell_metrics", sql="SELECT sample AS file, unnest(['Cells', 'Valid']) AS metric, unnest([CAST(value * 1000 + 7 AS DOUBLE), 97.5]) AS value FROM cell_metrics")
def s13_cell_summary(metrics):
    text = _lines("Cells,Valid", F.concat(F.lit('"'), F.col("value").cast("string"), F.lit(',007",97.5%')))
    return qc.cell_summary(_texts(metrics, F.col("sample"), text)).select("file", "metric", "value")


@query("cell_metrics", sql="SELECT sample AS file, 'Gene Expression' AS library_type, 'Cells' AS metric, CAST(value * 1000 + 7 AS DOUBLE) AS value FROM cell_metrics")
def s14_library_summary(metrics):
    row = F.concat(F.lit('Library,Gene Expression,,,Cells,"'), F.col("value").cast("string"), F.lit(',007"'))
    text = _lines("Library or Sample,Library Type,Grouped By,Group Name,Metric Name,Metric Value", row)
    return qc.library_summary(_texts(metrics, F.col("sample"), text)).select("file", "library_type", "metric", "value")


@query("supplier", sql="SELECT 'f' || s_suppkey AS file, unnest(['Cells', 'Valid']) AS metric, unnest([CAST(s_suppkey * 1000 + 7 AS DOUBLE), 97.5]) AS value FROM supplier")
def s13_cell_summary_files(supplier):
    text = _lines("Cells,Valid", F.concat(F.lit('"'), F.col("s_suppkey").cast("string"), F.lit(',007",97.5%')), "")
    return _read(supplier, text, qc.cell_summary).select("file", "metric", "value")


@query("supplier", sql="SELECT 'f' || s_suppkey AS file, CAST(s_suppkey * 1000 + 7 AS DOUBLE) AS value FROM supplier")
def s14_library_summary_files(supplier):
    """The first of a file's rows of the metric, of the library type asked for."""
    row = lambda kind, k: F.concat(F.lit(f'Library,{kind},,,Cells,"'), k.cast("string"), F.lit(',007"'))
    text = _lines("Library or Sample,Library Type,Grouped By,Group Name,Metric Name,Metric Value", row("Antibody Capture", F.lit(9)), row("Gene Expression", F.col("s_suppkey")), row("Gene Expression", F.lit(8)))
    return _read(supplier, text, lambda texts: qc.metric_by_type(qc.library_summary(texts), "Cells"))


@query("supplier", sql="""SELECT 'f' || s_suppkey AS file, unnest(['mean 1', 'A', 'B', 'deduplicated']) AS name,
 unnest([CAST(s_suppkey % 7 AS DOUBLE), (s_suppkey % 7 + 1.5) / 200, (s_suppkey % 5 + 2.5) / 200, s_suppkey % 100]) AS value FROM supplier""")
def a13_a14_a15_module_files(supplier):
    """Three modules of one file, read once."""
    k = lambda m: (F.col("s_suppkey") % m).cast("string")
    text = _lines(
        "##FastQC\t0.11", ">>Per base sequence quality\tpass", "#Base\tMean", F.concat_ws("\t", F.lit("1"), F.concat(k(7), F.lit(".9")), *[F.lit("30.0")] * 5), ">>END_MODULE",
        ">>Sequence Duplication Levels\tpass", F.concat(F.lit("#Total Deduplicated Percentage\t"), k(100)), "1\t2\t3", ">>END_MODULE",
        ">>Adapter Content\tpass", "#Position\tA\tB", F.concat_ws("\t", F.lit("1"), k(7), k(5)), "2-3\t1.5\t2.5", ">>END_MODULE",
    )
    found = shared.cut(_read(supplier, text, qc.fastqc_modules))
    mean = qc.base_quality(found).select("file", F.concat(F.lit("mean "), "base").alias("name"), F.col("mean").cast("double").alias("value"))
    content = qc.adapter_content(found).select("file", F.col("adapter").alias("name"), F.col("content").alias("value"))
    return mean.unionByName(content).unionByName(qc.deduplicated(found).select("file", F.lit("deduplicated").alias("name"), F.col("percent").alias("value")))


@query("reads", sql=f"""WITH h AS (SELECT lane, length(sequence) AS length, {KIND} AS kind, count(*) AS n FROM reads GROUP BY ALL), t AS (SELECT lane, sum(n) AS nreads, sum(n) FILTER (kind = 'masked') AS m FROM h GROUP BY lane)
SELECT h.lane || '' AS fastq, 'seq_lengths_dist' AS dist, length, sum(n) AS n, any_value(CAST(m AS DOUBLE) * 100 / CAST(nreads AS DOUBLE)) AS frac_reads_masked FROM h JOIN t ON t.lane = h.lane GROUP BY h.lane, length
UNION ALL SELECT h.lane || '', CASE kind WHEN 'masked' THEN 'seq_lengths_masked_dist' ELSE 'seq_lengths_padded_dist' END, length, n, CAST(m AS DOUBLE) * 100 / CAST(nreads AS DOUBLE) FROM h JOIN t ON t.lane = h.lane WHERE kind <> 'clean'""", ints="length", longs="n")
def s15_lengths_json(reads):
    """Statistics of each lane, written as JSON files and read back."""
    spark, path = reads.sparkSession, shared.new_folder(reads.sparkSession, "lengths")
    named = reads.withColumn("file", F.col("lane").cast("string"))
    tables.lengths_json(L.length_records(named)).write.text(path)
    found = tables.read_lengths(spark, path, "part-*", lines=True)
    one = lambda d: found.select("fastq", F.lit(d).alias("dist"), F.explode(d).alias("length", "n"), "frac_reads_masked")
    whole, masked, padded = (one(d) for d in tables.DISTRIBUTIONS)
    return whole.unionByName(masked).unionByName(padded)


@query("registry", sql="SELECT project AS entity, user_name, pi, CASE WHEN library <> '.' THEN library END AS library, CASE WHEN organism <> '.' THEN organism END AS other FROM registry")
def s16_metadata(registry):
    """A file for each project, in folders; undeclared keys go to a map."""
    named = registry.withColumnRenamed("project", "entity")
    lines = tables.metadata_lines(named, ("user_name", "pi", "library", "organism"))
    text = lines.groupBy("entity").agg(F.array_join(F.collect_list("value"), "\n").alias("text"))
    path = _written(text, F.col("entity"), F.col("text"), "metadata")
    found = tables.read_metadata(registry.sparkSession, path, ("user_name", "pi", "library"), "*.txt")
    return found.select(_of("entity").alias("entity"), "user_name", "pi", "library", F.col("others")["organism"].alias("other"))


@query("registry", sql="SELECT project, disabled, user_name AS \"User\", pi AS \"PI\", CASE WHEN library <> '.' THEN library END AS \"Library\", NULL::VARCHAR AS \"Comments\" FROM registry")
def s17_project_table(registry):
    """Written with some of the default columns, in another order, and read back."""
    path = shared.new_folder(registry.sparkSession, "projects")
    tables.write_projects(registry.select("project", "disabled", F.col("pi").alias("PI"), F.col("user_name").alias("User"), F.col("library").alias("Library")), path)
    return tables.read_projects(registry.sparkSession, path, "part-*").select("project", "disabled", "User", "PI", "Library", "Comments")


@query("part", sql="""SELECT 'p' || (p_partkey % 9) AS package, string_agg(DISTINCT CAST(p_partkey % 4 AS VARCHAR), ',' ORDER BY CAST(p_partkey % 4 AS VARCHAR)) AS versions FROM part GROUP BY 1
UNION ALL SELECT 'absent', ''""")
def s18_versions(part):
    k = F.col("p_partkey")
    path = shared.new_folder(part.sparkSession, "versions")
    part.select(F.concat(F.lit("p"), (k % 9).cast("string"), F.lit("\t"), (k % 4).cast("string")).alias("value")).write.text(path)
    wanted = [*[f"p{i}" for i in range(9)], "absent"]
    return tables.read_versions(part.sparkSession, path, "part-*", wanted).withColumn("versions", F.array_join("versions", ","))


@query("fastq_files", sql="SELECT project || '/' || fastq AS path FROM fastq_files WHERE lane > 2 OR n_reads % 3 = 0")
def i01_new_files(files):
    now = files.select(F.concat_ws("/", "project", "fastq").alias("path"), F.lit(5).alias("modified"), "lane", "n_reads")
    done = now.filter("lane <= 2").select("path", F.when(F.col("n_reads") % 3 == 0, 4).otherwise(5).alias("modified"))
    return tables.newer_than(now, done).select("path")


def _followed(reads, landings: int = 1) -> tuple:
    """Reads that land in so many turns, and are counted in as many batches."""
    spark = reads.sparkSession
    source, target, state = (shared.new_folder(spark, x) for x in ("landed", "counted", "state"))
    landed = reads.select(_file().alias("file"), "lane", "barcode", (F.col("l_orderkey") % landings).alias("turn"))
    for k in range(landings):
        landed.filter(F.col("turn") == k).write.mode("append").parquet(source)
        incremental.follow(spark, source, landed.schema, target, state, compact_every=2).awaitTermination()
    return spark, target


@query("reads", sql=f"SELECT {FILE_SQL} AS file, lane, count(*) AS n_reads FROM reads GROUP BY ALL")
def i02_stream_counts(reads):
    return incremental.counted(*_followed(reads))


@query("reads", sql=COUNTS)
def i02_stream_barcodes(reads):
    """Of three landings, two are folded into snapshots."""
    return incremental.counted_barcodes(*_followed(reads, 3))
