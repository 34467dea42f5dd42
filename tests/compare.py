"""Order-insensitive comparison of a Spark result with DuckDB's."""

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def differences(frame, connection, sql: str) -> str | None:
    """None when equal, else what differs."""
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    order = sorted(names)
    expected = sorted((tuple(r[names.index(n)] for n in order) for r in cursor.fetchall()), key=repr)
    actual = sorted((tuple(r) for r in frame.select(*order).collect()), key=repr)
    if expected == actual:
        return None
    extra = [r for r in actual if r not in set(expected)][:2]
    missing = [r for r in expected if r not in set(actual)][:2]
    return f"{len(actual)} rows, expected {len(expected)}; extra {extra!r:.600}; missing {missing!r:.600}"
