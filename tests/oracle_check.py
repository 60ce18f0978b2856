"""Run every ``queries()`` entry on Spark and its ``oracle_sql()`` on DuckDB and
compare row count, column names and (order-insensitive) values.

    python tests/oracle_check.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import json
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

RAW = ("region nation customer supplier part orders lineitem events documents embeddings "
       "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in RAW:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


SPARK_TYPES = {"bigint": "int", "int": "int", "string": "str", "date": "date",
               "timestamp_ntz": "ts", "timestamp": "ts", "boolean": "bool", "double": "float"}
DUCK_TYPES = {"BIGINT": "int", "INTEGER": "int", "VARCHAR": "str", "DATE": "date",
              "TIMESTAMP": "ts", "BOOLEAN": "bool", "DOUBLE": "float"}


def type_kinds(df, relation) -> tuple[dict, dict]:
    spark_kinds = {f.name: SPARK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    duck_kinds = {c: DUCK_TYPES.get(str(t), str(t))
                  for c, t in zip(relation.columns, relation.types)}
    return spark_kinds, duck_kinds


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    vals = sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)
    return cols, vals


def compare(spark, sf_dir: str, names=None) -> dict:
    import __spark_entry__ as E
    qs, oracle = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    report = {}
    for name in (names or list(qs)):
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        srows = [tuple(r) for r in df.collect()]
        t1 = time.time()
        res = {"spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
        if name in oracle:
            cur = con.execute(oracle[name])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
            scols, svals = canon(df.columns, srows)
            ocols, ovals = canon(dcols, drows)
            skinds, dkinds = type_kinds(df, con.sql(oracle[name]))
            res.update(oracle_rows=len(drows), columns_match=scols == ocols,
                       types_match=skinds == dkinds, values_match=svals == ovals)
            if scols != ocols:
                res["spark_columns"], res["oracle_columns"] = scols, ocols
            elif svals != ovals:
                diff = [x for x in svals if x not in ovals][:3]
                res["spark_only"] = [list(map(str, d)) for d in diff]
                res["oracle_only"] = [list(map(str, d)) for d in
                                      [x for x in ovals if x not in svals][:3]]
        report[name] = res
    return report


if __name__ == "__main__":
    from reachlens.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    out = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in out.items() if not v.get("values_match", True)
           or not v.get("columns_match", True) or not v.get("types_match", True)]
    for k, v in out.items():
        print(k, json.dumps(v))
    print("MISMATCH:", bad if bad else "none")
