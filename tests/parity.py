"""Compare a Spark result with a DuckDB result: columns, types and every value."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def spark_rows(df):
    names = sorted(df.columns)
    return names, Counter(tuple(_plain(row[n]) for n in names) for row in df.collect())


def duck_rows(con, sql):
    result = con.execute(sql)
    found = [column[0] for column in result.description]
    names = sorted(found)
    places = [found.index(n) for n in names]
    return names, Counter(tuple(_plain(row[p]) for p in places) for row in result.fetchall())


def kinds(rows: Counter) -> list[set]:
    """The Python types in each column, nulls aside."""
    columns = zip(*rows)
    return [{type(v) for v in column if v is not None} for column in columns]


def assert_same(df, con, sql):
    names, mine = spark_rows(df)
    other_names, theirs = duck_rows(con, sql)
    assert names == other_names
    only_mine, only_theirs = mine - theirs, theirs - mine
    assert not only_mine and not only_theirs, (
        f"{sum(mine.values())} and {sum(theirs.values())} rows; columns {names}; "
        f"only Spark {sum(only_mine.values())}: {list(only_mine)[:2]}; "
        f"only DuckDB {sum(only_theirs.values())}: {list(only_theirs)[:2]}"
    )
    assert kinds(mine) == kinds(theirs), f"{names}: {kinds(mine)} and {kinds(theirs)}"


