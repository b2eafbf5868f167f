"""Spark result against SQL result: same columns, same rows, any order.

``python tests/oracle_check.py SF_DIR [NAME ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(spark_df, con, sql: str):
    cur = con.execute(sql)
    want_cols, want = _rows([d[0] for d in cur.description], cur.fetchall())
    got_cols, got = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if want_cols != got_cols:
        return f"columns {got_cols} != {want_cols}", sum(got.values())
    if want != got:
        return (f"extra {list((got - want).items())[:2]} missing {list((want - got).items())[:2]} "
                f"rows {sum(got.values())}/{sum(want.values())}"), sum(got.values())
    return None, sum(got.values())


def main(sf_dir: str, names: list[str]) -> None:
    import __spark_entry__ as contract
    from marquee.session import local_session

    spark, con = local_session("8", 8), connect(sf_dir)
    queries, oracle = contract.queries(), contract.oracle_sql()
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracle:
                problem, rows = differences(df, con, oracle[name])
            else:
                problem, rows = "no oracle", df.count()
        except Exception as error:  # report and go on with the next query
            problem, rows = f"{type(error).__name__}: {str(error)[:600]}", -1
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} rows={rows} "
              f"{time.time() - start:.1f}s {problem or ''}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
