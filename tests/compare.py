"""Run registered queries beside their SQL in DuckDB: ``python -m tests.compare [names]``."""

from __future__ import annotations

import decimal
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, decimal.Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, bytearray | bytes):
        return bytes(value).hex()
    if isinstance(value, list | tuple):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple((k, plain(v)) for k, v in value.items())
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda n: columns[n])
    names = [columns[n] for n in order]
    return names, sorted((tuple(plain(r[n]) for n in order) for r in rows), key=repr)


def database(sf_dir: str):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def compare(spark, connection, sf_dir, name, query, sql):
    """(number of rows, None or a description of the difference)."""
    frame = query(spark, sf_dir)
    got_names, got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    if sql is None:
        return len(got), None
    cursor = connection.execute(sql)
    want_names, want = rows_of([c[0] for c in cursor.description], cursor.fetchall())
    if got_names != want_names:
        return len(got), f"columns {got_names} != {want_names}"
    if got != want:
        only_got, only_want = list(set(got) - set(want)), list(set(want) - set(got))
        return len(got), (
            f"{len(got)} rows, expected {len(want)}; {len(only_got)} surplus {only_got[:2]}, "
            f"{len(only_want)} lacking {only_want[:2]}"
        )
    return len(got), None


def main(names: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from revtide import build_session

    sf = "0.01"
    if names and names[0].startswith("sf"):
        sf = names.pop(0)[2:]
    spark = build_session("compare", 8)
    spark.sparkContext.setLogLevel("OFF")
    sf_dir = f"/root/testdata/sf{sf}"
    connection, oracles, failures = database(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        begin = time.time()
        try:
            count, fault = compare(spark, connection, sf_dir, name, query, oracles.get(name))
        except Exception as error:
            count, fault = 0, f"{type(error).__name__}: {str(error)[:1500]}"
        failures += fault is not None
        kind = "sql " if name in oracles else "rows"
        state = "ok" if fault is None else "FAIL " + fault
        print(f"{kind} {name:26} {count:7} {time.time() - begin:6.2f}s {state}", flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
