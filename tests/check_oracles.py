"""Runs registered queries next to their SQL: ``python tests/check_oracles.py [dir] [name…]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir: str, name: str, query, sql: str | None) -> tuple[str, int]:
    """'ok' or what differs, and the number of rows."""
    result = query(spark, sf_dir)
    got = rows_of(result.columns, result.collect())
    if sql is None:
        return "no SQL", len(got)
    relation = con.sql(sql)
    want = rows_of(relation.columns, relation.fetchall())
    kinds = {"bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN", "int": "INTEGER"}
    types = {c: kinds.get(t, t) for c, t in result.dtypes}
    wanted = dict(zip(relation.columns, map(str, relation.types), strict=True))
    if types != wanted:
        return f"types: spark {types} duckdb {wanted}", len(got)
    if len(got) != len(want):
        return f"rows: spark {len(got)} duckdb {len(want)}", len(got)
    for mine, theirs in zip(got, want, strict=True):
        if mine != theirs:
            return f"values: spark {mine} duckdb {theirs}", len(got)
    return "ok", len(got)


def main() -> int:
    import __spark_entry__ as entry
    from relayframe.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = connect(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        started = time.time()
        try:
            verdict, n = compare(spark, con, sf_dir, name, query, sql.get(name))
        except Exception as error:  # noqa: BLE001 - report every query
            verdict, n = f"error: {str(error)[:600]}", -1
        failed += verdict not in ("ok", "no SQL")
        print(f"{name:32s} {n:7d} rows {time.time() - started:6.2f} s  {verdict}", flush=True)
    print("failed:", failed, "without a query:", sorted(set(sql) - set(entry.queries())))
    return failed


if __name__ == "__main__":
    sys.exit(main())
