"""Run queries beside their SQL on the given tables and compare types and values.

usage: python tools/compare.py SF_DIR [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
import pyarrow as pa

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain_type(kind: pa.DataType) -> str:
    text = str(kind)
    return {"large_string": "string", "decimal128(38, 0)": "int64"}.get(text, "timestamp" if text.startswith("timestamp") else text)


def rows_of(table: pa.Table) -> list[tuple]:
    columns = sorted(table.column_names)
    lists = []
    for c in columns:
        column = table[c]
        if pa.types.is_timestamp(column.type):
            column = column.cast(pa.timestamp("us"))
        lists.append([None if isinstance(v, float) and math.isnan(v) else v for v in column.to_pylist()])
    return sorted(zip(*lists), key=repr) if lists else []


def differences(spark_table: pa.Table, sql_table: pa.Table) -> list[str]:
    found = []
    left = {c: _plain_type(spark_table.schema.field(c).type) for c in spark_table.column_names}
    right = {c: _plain_type(sql_table.schema.field(c).type) for c in sql_table.column_names}
    if left != right:
        found.append(f"schema {sorted(set(left.items()) ^ set(right.items()))}")
    a, b = rows_of(spark_table), rows_of(sql_table)
    if len(a) != len(b):
        found.append(f"rows {len(a)} vs {len(b)}")
    if left.keys() == right.keys() and a != b:
        odd = [(x, y) for x, y in zip(a, b) if x != y]
        found.append(f"{len(odd)} differing rows of {len(a)}, first {odd[:2]}")
    return found


def main() -> int:
    from catalogue import ORACLES, QUERIES
    from millrace.session import build_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session("compare", "8", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            got = QUERIES[name](spark, sf_dir).toArrow()
            seconds = time.time() - start
            if name in ORACLES:
                sql_start = time.time()
                found = differences(got, con.execute(ORACLES[name]).to_arrow_table())
                verdict = ("OK" if not found else "DIFF " + "; ".join(found)) + f" (sql {time.time() - sql_start:.1f}s)"
                failed += bool(found)
            else:
                verdict = "no SQL"
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            failed += 1
            verdict, seconds, got = "ERROR " + str(error)[:1500], time.time() - start, None
        print(f"{name:28s} {seconds:6.2f}s rows={got.num_rows if got else '-'} {verdict}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
