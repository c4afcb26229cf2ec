"""Run a query in Spark and its oracle in DuckDB and compare the results as sets of rows."""

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shown = [tuple(None if r[i] is None else str(r[i]) for i in order) for r in rows]
    return sorted(shown, key=repr)


KINDS = {"boolean": "BOOLEAN", "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE"}


def difference(df, connection, sql):
    """None if equal, else a description of the first difference; and the number of rows."""
    relation = connection.sql(sql)
    expected, names = relation.fetchall(), list(relation.columns)
    kinds = dict(zip(names, map(str, relation.types)))
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}", 0
    wrong = {c: (k, kinds[c]) for c, k in df.dtypes if KINDS.get(k) != kinds[c]}
    actual = [tuple(r) for r in df.collect()]
    if len(actual) != len(expected):
        return f"{len(actual)} rows != {len(expected)}", len(actual)
    for mine, theirs in zip(normal(actual, df.columns), normal(expected, names)):
        if mine != theirs:
            return f"{mine} != {theirs}", len(actual)
    return (f"types {wrong}" if wrong else None), len(actual)
