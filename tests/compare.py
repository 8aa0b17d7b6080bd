"""Spark query against SQL, as multisets of rows, with column names and types."""

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()

ORACLE_TYPES = {
    "VARCHAR": "string",
    "INTEGER": "int",
    "BIGINT": "bigint",
    "DATE": "date",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
}


def oracle(sf_dir, sql):
    connection = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        connection.execute(f"create view {table} as select * from '{path}'")
    result = connection.execute(sql)
    types = {d[0]: ORACLE_TYPES[str(d[1])] for d in result.description}
    return types, result.fetchall()


def rows_by_name(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(_key(row[i]) for i in order) for row in rows)


def _key(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return "\0" if value is None else str(value)


def assert_same(df, sf_dir, sql):
    types, expected = oracle(sf_dir, sql)
    assert dict(df.dtypes) == types
    actual = rows_by_name(df.columns, df.collect())
    wanted = rows_by_name(list(types), expected)
    assert len(actual) == len(wanted)
    assert actual == wanted
    return len(actual)
