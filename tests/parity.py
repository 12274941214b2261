"""Spark-vs-DuckDB parity check used by the tests and by hand.

Runs ``queries()[name](spark, sf_dir)`` and ``oracle_sql()[name]`` on the
same parquet tables and compares column names, row counts and values
(order-insensitive, doubles to 6 decimals).
"""
from __future__ import annotations

import math
import os
import sys

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return tuple(_norm(x) for x in v.tolist())
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    return v


def _rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in pdf.to_dict("records")]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


SPARK_TO_DUCK = {"tinyint": "TINYINT", "smallint": "SMALLINT", "int": "INTEGER", "bigint": "BIGINT",
                 "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR", "boolean": "BOOLEAN",
                 "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


def type_mismatches(sdf_spark, rel) -> list[str]:
    """Columns whose Spark type and DuckDB type differ (by family name)."""
    duck_types = {n: str(t) for n, t in zip(rel.columns, rel.dtypes)}
    out = []
    for n, t in sdf_spark.dtypes:
        want = SPARK_TO_DUCK.get(t, t.upper())
        got = duck_types.get(n, "?")
        if not (got == want or (t.startswith("decimal") and got.startswith("DECIMAL"))):
            out.append(f"{n}: spark {t} vs duckdb {got}")
    return out


def compare(spark, name: str, fn, sql: str, sf_dir: str, con=None, check_types=False) -> tuple[bool, str]:
    con = con or duck(sf_dir)
    sdf_spark = fn(spark, sf_dir)
    sdf = sdf_spark.toPandas()
    odf = con.execute(sql).fetchdf()
    if check_types:
        mism = type_mismatches(sdf_spark, con.sql(sql))
        if mism:
            return False, "types differ: " + "; ".join(mism)
    if sorted(sdf.columns) != sorted(odf.columns):
        return False, f"columns differ: spark={sorted(sdf.columns)} oracle={sorted(odf.columns)}"
    if len(sdf) != len(odf):
        return False, f"row count differs: spark={len(sdf)} oracle={len(odf)}"
    a, b = _rows(sdf), _rows(odf)
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return False, f"value differs at sorted row {i}: spark={x} oracle={y} cols={sorted(sdf.columns)}"
    return True, f"ok ({len(sdf)} rows)"


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from cohort_spark import get_spark
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    spark = get_spark()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        if name not in sqls:
            n = fn(spark, sf_dir).count()
            print(f"[rows-only] {name}: {n} rows")
            continue
        try:
            ok, msg = compare(spark, name, fn, sqls[name], sf_dir, con,
                              check_types=os.environ.get("PARITY_TYPES") == "1")
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"error: {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"[{'PASS' if ok else 'FAIL'}] {name}: {msg}", flush=True)
    print(f"{bad} failing")


if __name__ == "__main__":
    main(sys.argv)
