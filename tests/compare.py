"""Run registered queries beside their SQL and report differences.

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import tempfile
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# COMPARE_EXACT=1 demands equal doubles; by default nine digits have to agree.
EXACT = os.environ.get("COMPARE_EXACT") == "1"

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def oracle(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def normal(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float, decimal.Decimal)):
        return float(v) if EXACT else float(f"{float(v):.9g}")
    if isinstance(v, (datetime.datetime, datetime.date)):
        return str(v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def differences(spark_df, con, sql) -> str | None:
    mine = rows_of(spark_df.columns, spark_df.collect())
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    theirs = rows_of(columns, result.fetchall())
    if sorted(columns) != sorted(spark_df.columns):
        return f"columns: spark only {set(spark_df.columns) - set(columns)}, sql only {set(columns) - set(spark_df.columns)}"
    if mine == theirs:
        return None if mine else "both empty"
    extra, absent = list(set(mine) - set(theirs))[:2], list(set(theirs) - set(mine))[:2]
    return f"{len(mine)} vs {len(theirs)} rows; columns {sorted(columns)}\n  spark only {extra}\n  sql only {absent}"


def main() -> None:
    import __spark_entry__ as entry
    from dialwright.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = sys.argv[2:] or list(entry.queries())
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="compare-")})
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            df = entry.queries()[name](spark, sf_dir)
            sql = entry.oracle_sql().get(name)
            if sql is None:
                n = len(df.collect())
                verdict = f"rows only: {n}"
            else:
                diff = differences(df, con, sql)
                verdict = "ok" if diff is None else f"DIFF {diff}"
        except Exception as e:  # noqa: BLE001
            verdict = f"ERROR {type(e).__name__}: {str(e)[:1500]}"
        failed += verdict.startswith(("DIFF", "ERROR"))
        print(f"{name:28s} {time.time() - start:6.2f}s {verdict}", flush=True)
    print(f"{failed} failed of {len(names)}")


if __name__ == "__main__":
    main()
