"""Compare a Spark result with DuckDB on the same tables."""

from pathlib import Path

import duckdb

TESTDATA = Path("/root/testdata")


def connect(folder: Path) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in sorted(folder.glob("*.parquet")):
        files = f"{table}/*.parquet" if table.is_dir() else table
        con.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM read_parquet('{files}')")
    return con


# DuckDB type for each Spark type that results may have.
TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def spark_rows(df) -> tuple[dict[str, str], list]:
    columns = sorted(df.columns)
    types = {c: TYPES[t] for c, t in df.dtypes}
    return types, _sorted([tuple(row[c] for c in columns) for row in df.collect()])


def duck_rows(con, sql: str) -> tuple[dict[str, str], list]:
    relation = con.sql(sql)
    types = dict(zip(relation.columns, map(str, relation.types)))
    order = sorted(range(len(relation.columns)), key=lambda i: relation.columns[i])
    return types, _sorted([tuple(row[i] for i in order) for row in relation.fetchall()])


def _sorted(rows: list) -> list:
    return sorted(rows, key=lambda row: [(v is not None, v) for v in row])
