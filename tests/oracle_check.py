"""Run registered queries next to their SQL over the same Parquet files and compare the results.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

import datetime
import decimal
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def normal(value):
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, sf_dir, build, sql):
    df = build(spark, sf_dir)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    theirs = rows_of([d[0] for d in cur.description], cur.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}", len(mine[1])
    if mine[1] == theirs[1]:
        return None, len(mine[1])
    a, b = set(map(repr, mine[1])), set(map(repr, theirs[1]))
    return (f"rows {len(mine[1])} vs {len(theirs[1])}; only spark {sorted(a - b)[:2]}; "
            f"only sql {sorted(b - a)[:2]}"), len(mine[1])


def main():
    from __spark_entry__ import oracle_sql, queries
    from ledgerloom.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark, con, oracles, failures = local_session("oracle", "8"), connect(sf_dir), oracle_sql(), 0
    for name, build in queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            if name in oracles:
                problem, n = compare(spark, con, sf_dir, build, oracles[name])
            else:
                problem, n = None, build(spark, sf_dir).count()
        except Exception as exc:  # report and go on
            problem, n = f"{type(exc).__name__}: {str(exc)[:700]}", 0
        failures += problem is not None
        kind = "FAIL" if problem else "ok" if name in oracles else "rows"
        print(f"\n{kind:5s}{name:32s}{n:9d}{time.time() - start:8.2f}s {problem or ''}", flush=True)
    spark.stop()
    return failures


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
