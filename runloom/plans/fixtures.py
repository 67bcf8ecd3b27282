"""Fixture views over the driver tables: the same SQL text for Spark and DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Views in the order of their needs.
VIEWS = {
    "reads": """
SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_linenumber % 4 + 1 AS INT) AS lane, project0 AS true_project,
 CASE WHEN l_orderkey % 11 = 0 THEN 'Undetermined_indices' ELSE project0 END AS project,
 CASE WHEN l_orderkey % 11 = 0 THEN 'lane' || CAST(l_linenumber % 4 + 1 AS STRING) ELSE sample0 END AS sample,
 CASE WHEN l_orderkey % 11 = 0 THEN substr(bc0,1,CAST(l_partkey % 8 AS INT)) || substr('ACGTN',CAST(l_partkey % 5 AS INT)+1,1) || substr(bc0,CAST(l_partkey % 8 AS INT)+2)
      ELSE bc0 END AS barcode,
 CASE WHEN l_partkey % 17 = 0 THEN repeat('N', slen) WHEN l_partkey % 13 = 0 THEN substr(seq0,1,slen-3) || 'NNN' ELSE substr(seq0,1,slen) END AS sequence,
 substr(qual0,1,slen) AS quality
FROM (SELECT l_orderkey, l_linenumber, l_partkey,
  'P' || CAST(l_suppkey % 3 AS STRING) AS project0, 'S' || CAST(l_suppkey % 20 AS STRING) AS sample0,
  translate(substr(md5('bc' || CAST(l_suppkey % 20 AS STRING)),1,8),'0123456789abcdef','ACGTACGTACGTACGT') AS bc0,
  translate(md5(CAST(l_orderkey AS STRING) || '_' || CAST(l_linenumber AS STRING)),'0123456789abcdef','ACGTACGTACGTACGT') AS seq0,
  translate(md5(CAST(l_partkey AS STRING) || '_' || CAST(l_linenumber AS STRING)),'0123456789abcdef','!#&*+-29;<>?BDFH') AS qual0,
  CAST(20 + l_partkey % 13 AS INT) AS slen FROM lineitem) t
""",
    "sample_sheet": """
SELECT CAST(r_regionkey + 1 AS INT) AS lane, 'S' || CAST(s_suppkey AS STRING) AS sample, 'P' || CAST(s_suppkey % 3 AS STRING) AS project,
 translate(substr(md5('bc' || CAST(s_suppkey AS STRING)),1,8),'0123456789abcdef','ACGTACGTACGTACGT') AS index_seq
FROM supplier CROSS JOIN region WHERE s_suppkey < 22 AND r_regionkey < 4
""",
    "fastq_files": """
SELECT d.project, d.sample, d.lane, r.read_number, r.is_index, d.n_reads, d.n_reads * 40 + r.read_number AS size_bytes,
 CASE WHEN d.project = 'Undetermined_indices' THEN 'Undetermined_S0' ELSE d.sample || '_S' || CAST(CAST(substr(d.sample,2) AS INT) + 1 AS STRING) END
 || '_L00' || CAST(d.lane AS STRING) || CASE WHEN r.is_index THEN '_I' ELSE '_R' END || CAST(r.read_number AS STRING) || '_001.fastq.gz' AS fastq
FROM (SELECT project, sample, lane, count(*) AS n_reads FROM reads GROUP BY project, sample, lane) d
CROSS JOIN (SELECT CASE WHEN r_regionkey = 2 THEN 1 ELSE CAST(r_regionkey AS INT) + 1 END AS read_number, r_regionkey = 2 AS is_index FROM region WHERE r_regionkey < 3) r
""",
    "registry": """
SELECT 'P' || CAST(n_nationkey AS STRING) AS project, 'user' || CAST(n_nationkey % 4 AS STRING) AS user_name,
 CASE WHEN n_nationkey % 7 = 0 THEN NULL ELSE 'PI' || CAST(n_regionkey AS STRING) END AS pi,
 CASE WHEN n_nationkey % 3 = 0 THEN 'Human,Mouse' WHEN n_nationkey % 3 = 1 THEN ' Xenopus  tropicalis' ELSE '.' END AS organism,
 CASE WHEN n_nationkey % 5 = 0 THEN '.' ELSE 'RNA-seq' END AS library, n_nationkey % 6 = 5 AS disabled
FROM nation
""",
    "cell_metrics": """
SELECT 'P' || CAST(c_nationkey AS STRING) AS project, 'C' || CAST(c_custkey AS STRING) AS sample,
 CASE c_custkey % 4 WHEN 0 THEN 'Estimated Number of Cells' WHEN 1 THEN 'Estimated number of cells' WHEN 2 THEN 'annotated_cells' ELSE 'Cells' END AS metric,
 CAST(floor(abs(c_acctbal)) AS BIGINT) AS value
FROM customer
""",
    "series": """
SELECT event_type AS series, event_id AS x, value AS y FROM events
""",
}
NEEDS = {
    "reads": ("lineitem",), "sample_sheet": ("supplier", "region"), "fastq_files": ("reads", "region"),
    "registry": ("nation",), "cell_metrics": ("customer",), "series": ("events",),
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture view, or a driver table, as a DataFrame. SQL gets its inputs as
    arguments, so nothing is registered in the session."""
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    inputs = {n: view(spark, sf_dir, n) for n in NEEDS[name]}
    text = VIEWS[name]
    for n in inputs:
        text = text.replace(f"FROM {n} ", f"FROM {{{n}}} ").replace(f"FROM {n})", f"FROM {{{n}}})").replace(f"FROM {n}\n", f"FROM {{{n}}}\n").replace(f"JOIN {n} ", f"JOIN {{{n}}} ")
    return spark.sql(text, **inputs)


def with_views(names: tuple[str, ...], query: str) -> str:
    """DuckDB SQL: the views as common table expressions before the query."""
    wanted: list[str] = []
    for n in names:
        wanted += [x for x in (*NEEDS.get(n, ()), n) if x in VIEWS and x not in wanted]
    body = query.strip()
    if body[:5].upper() == "WITH ":
        body = ", " + body[5:]
    heads = ", ".join(f"{n} AS ({VIEWS[n].strip()})" for n in wanted)
    return f"WITH {heads} {body}" if heads else query.strip()
