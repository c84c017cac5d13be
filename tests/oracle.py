"""Compare a registered query with its SQL in DuckDB: row count, columns, values in any order."""

import decimal
import datetime as dt

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def canonical(value):
    if isinstance(value, decimal.Decimal):
        return format(value.normalize(), "f")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(canonical(row[i]) for i in order) for row in rows)


def difference(df, con, sql):
    """None if both agree, else a description."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    got = [tuple(r) for r in df.collect()]
    if len(got) != len(expected):
        return f"{len(got)} rows != {len(expected)}"
    left, right = rows_of(df.columns, got), rows_of(names, expected)
    for a, b in zip(left, right):
        if a != b:
            return f"{a} != {b} ({sorted(names)}; {kinds}; {dict(df.dtypes)})"
    return None
