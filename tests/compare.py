"""Compare a Spark result with its DuckDB oracle, ignoring row and column order."""

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def differences(df, con, sql: str) -> list[str]:
    """Empty when columns, row count and all values agree."""
    answer = con.execute(sql)
    names = [c[0] for c in answer.description]
    expected = answer.fetchall()
    if sorted(names) != sorted(df.columns):
        return [f"columns: spark {sorted(df.columns)} oracle {sorted(names)}"]
    actual = df.collect()
    if len(actual) != len(expected):
        return [f"rows: spark {len(actual)} oracle {len(expected)}"]
    pairs = zip(_sorted(df.columns, actual), _sorted(names, expected))
    return [f"spark {a} oracle {e}" for a, e in pairs if a != e or repr(a) != repr(e)]
