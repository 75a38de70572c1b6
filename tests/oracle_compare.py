"""Run a registered query and its SQL side by side and compare them as the driver does: by column name, in any order."""

from __future__ import annotations

import datetime
import math
import os

import duckdb

TESTDATA = os.environ.get("TILLROLL_TESTDATA", "/root/testdata")


def connect(sf_dir: str):
    con = duckdb.connect()
    for file in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM read_parquet('{sf_dir}/{file}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.isoformat(" ")
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def _sorted_rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(spark, con, query, sql: str, sf_dir: str) -> tuple[int, list[str]]:
    """Number of rows and a list of differences (empty when equal)."""
    df = query(spark, sf_dir)
    rows = df.collect()
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    wanted = result.fetchall()
    problems = []
    if sorted(df.columns) != sorted(names):
        return len(rows), [f"columns {sorted(df.columns)} != {sorted(names)}"]
    if len(rows) != len(wanted):
        problems.append(f"rows {len(rows)} != {len(wanted)}")
    left, right = _sorted_rows(rows, df.columns), _sorted_rows(wanted, names)
    for a, b in zip(left, right):
        if a != b:
            problems.append(f"{a} != {b}")
        elif [type(x) for x in a] != [type(x) for x in b]:
            problems.append(f"types of {a} != {b}")
        if len(problems) > 3:
            break
    return len(rows), problems
