"""Run a registered query next to its SQL check and report the first difference."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(tuple(plain(r[i]) for i in order) for r in rows)


def difference(spark_df, connection, sql):
    """None when equal, else a short text."""
    names, ours = rows_of(spark_df.columns, spark_df.collect())
    result = connection.execute(sql)
    wanted_names, wanted = rows_of([d[0] for d in result.description], result.fetchall())
    if names != wanted_names:
        return f"columns {names} != {wanted_names}"
    if ours != wanted:
        parts = [f"{sum(ours.values())} rows against {sum(wanted.values())}"]
        for i, name in enumerate(names):
            a, b = (Counter(row[i] for row in rows.elements()) for rows in (ours, wanted))
            if a != b:
                extra, missing = str(next(iter(a - b), "-"))[:200], str(next(iter(b - a), "-"))[:200]
                parts.append(f"{name}: {extra!r} against {missing!r}")
        return "; ".join(parts)
    return None if ours else "empty result"


def main():
    from estatelake.session import build_session

    import __spark_entry__ as entry

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                   "spark.ui.showConsoleProgress": "false",
                                   "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, queries, oracles = duck(folder), entry.queries(), entry.oracle_sql()
    bad = 0
    for name in wanted or queries:
        start = time.time()
        try:
            if name in oracles:
                problem = difference(queries[name](spark, folder), connection, oracles[name])
            else:
                count = queries[name](spark, folder).count()
                problem = None if count else "empty result"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        note = "ok" if problem is None else problem
        print(f"{name:32s} {time.time() - start:6.2f}s {'' if name in oracles else '(rows only) '}{note}", flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    main()
