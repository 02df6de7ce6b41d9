"""Run a registered query in Spark and its SQL in DuckDB and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import math
import sys

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cur = con.execute(sql)
    return rows_of([d[0] for d in cur.description], cur.fetchall())


def compare(name, df, con, sql) -> str | None:
    """None if equal, else what differs."""
    (sc, sr), (dc, dr) = spark_rows(df), duck_rows(con, sql)
    if sc != dc:
        return f"{name}: columns {sc} != {dc}"
    if len(sr) != len(dr):
        return f"{name}: {len(sr)} rows != {len(dr)}"
    for a, b in zip(sr, dr):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{name}: {a!r} != {b!r}"[:1500]
    return None


if __name__ == "__main__":
    import time

    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    import __spark_entry__ as entry
    from landsync.session import build_session

    sf = sys.argv[1]
    names = sys.argv[2:]
    spark = build_session("oracle", "local[8]", spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
                          spark__sql__shuffle__partitions="8", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for name, fn in entry.queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            df = fn(spark, sf)
            sql = entry.oracle_sql().get(name)
            note = compare(name, df, con, sql) if sql else f"rows only: {df.count()}"
        except Exception as e:  # noqa: BLE001
            note = f"{name}: {type(e).__name__} {str(e)[:900]}"
        ok = note is None or note.startswith("rows only")
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {name} {time.time() - start:.2f}s {note or ''}", flush=True)
    print(f"{bad} bad")
