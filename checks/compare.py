"""Compare a Spark result with its DuckDB statement, ignoring row and column order."""

import glob
import os

import duckdb


def open_tables(sf_dir):
    connection = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"create view {name} as select * from read_parquet('{path}')")
    return connection


def _plain(value):
    return bytes(value) if isinstance(value, (bytes, bytearray)) else value


def _sorted_rows(rows):
    return sorted((tuple(map(_plain, row)) for row in rows), key=repr)


def difference(frame, connection, sql):
    """None if both give the same columns and rows, else what differs first."""
    names = sorted(frame.columns)
    answer = connection.sql(sql)
    if names != sorted(answer.columns):
        return f"columns {names} and {sorted(answer.columns)}"
    quoted = ", ".join(f'"{name}"' for name in names)
    ours = _sorted_rows(frame.select(*names).collect())
    theirs = _sorted_rows(connection.sql(f"select {quoted} from ({sql}) as answer").fetchall())
    if len(ours) != len(theirs):
        return f"{len(ours)} rows and {len(theirs)} rows"
    for left, right in zip(ours, theirs):
        if left != right or [type(v) for v in left] != [type(v) for v in right]:
            return f"{str(left)[:2000]}\n{str(right)[:2000]}"
    return None
