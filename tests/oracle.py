"""Compare a registered query with its SQL in DuckDB."""

import math
import os

import duckdb
import pyarrow as pa

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{os.path.join(folder, name)}.parquet')")
    return con


def type_name(dtype):
    text = str(dtype).replace("large_string", "string").replace("string_view", "string")
    return text.split("[")[0] if pa.types.is_timestamp(dtype) else text


def rows_of(table):
    names = sorted(table.column_names)

    def plain(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else repr(round(value, 6) + 0.0)
        return repr(value)

    columns = [[plain(v) for v in table.column(n).to_pylist()] for n in names]
    return sorted(zip(*columns))


def compare(df, con, sql):
    got, want = df.toArrow(), con.execute(sql).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    types = [{f.name: type_name(f.type) for f in t.schema} for t in (got, want)]
    assert types[0] == types[1]
    mine, theirs = rows_of(got), rows_of(want)
    assert len(mine) == len(theirs), (len(mine), len(theirs))
    assert mine == theirs, next((a, b) for a, b in zip(mine, theirs) if a != b)
    return len(mine)
