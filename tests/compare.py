"""Value comparison of a Spark result with the SQL engine's."""

from __future__ import annotations

import duckdb

GIVEN = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    engine = duckdb.connect()
    for name in GIVEN.split():
        engine.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return engine


def difference(spark_df, engine: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if equal as multisets with equal columns and like types, else what differs."""
    result = engine.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    order = sorted(names)
    expected = [tuple(r[names.index(n)] for n in order) for r in result.fetchall()]
    actual = [tuple(r[n] for n in order) for r in spark_df.collect()]
    if len(actual) != len(expected):
        return f"rows {len(actual)} != {len(expected)}"
    actual, expected = sorted(actual, key=repr), sorted(expected, key=repr)
    for a, e in zip(actual, expected):
        if a != e or [type(v) for v in a] != [type(v) for v in e]:
            return f"columns {order}: {a} != {e}"
    return None
