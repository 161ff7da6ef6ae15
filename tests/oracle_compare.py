"""Run a registered Spark query and its DuckDB oracle on the same test tables and compare
column names, column types and the multiset of rows (values compared exactly)."""

from __future__ import annotations

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "smallint": "SMALLINT",
    "tinyint": "TINYINT", "float": "FLOAT",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def compare(spark, query, sql: str, sf_dir: str, con=None) -> dict:
    df = query(spark, sf_dir)
    s_cols = df.columns
    s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in df.schema.fields}
    s_rows = [tuple(r) for r in df.collect()]
    con = con or duck(sf_dir)
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    d_rows = rel.fetchall()
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows)}
    out["columns_match"] = sorted(s_cols) == sorted(d_cols)
    out["types_match"] = out["columns_match"] and all(s_types[c] == d_types[c] for c in s_cols)
    if not out["columns_match"]:
        out["columns"] = (sorted(set(s_cols) - set(d_cols)), sorted(set(d_cols) - set(s_cols)))
        out["values_match"] = False
        return out
    if not out["types_match"]:
        out["types"] = {c: (s_types[c], d_types[c]) for c in s_cols if s_types[c] != d_types[c]}
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    s_norm = sorted((tuple(r[i] for i in si) for r in s_rows), key=_key)
    d_norm = sorted((tuple(r[i] for i in di) for r in d_rows), key=_key)
    out["values_match"] = s_norm == d_norm
    if not out["values_match"]:
        diffs = []
        sset, dset = set(s_norm), set(d_norm)
        only_s = [r for r in s_norm if r not in dset][:3]
        only_d = [r for r in d_norm if r not in sset][:3]
        for a, b in zip(only_s, only_d):
            diffs.append({c: (x, y) for c, x, y in zip(order, a, b) if x != y})
        out["diff_examples"] = diffs or {"only_spark": only_s, "only_oracle": only_d}
    return out
