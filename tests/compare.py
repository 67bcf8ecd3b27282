"""A query's rows against its SQL in DuckDB."""

import math

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        v = float(v)
        return "nan" if math.isnan(v) else f"{v:.6g}"
    return str(v)


def same(spark, sf_dir, query, sql):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    found = con.sql(sql)
    df = query(spark, sf_dir)
    columns = sorted(df.columns)
    assert columns == sorted(found.columns)
    at = [found.columns.index(c) for c in columns]
    want = sorted(tuple(plain(r[i]) for i in at) for r in found.fetchall())
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    assert got == want
