"""A copy of the tables in which one sensor, cycle and hour holds a third of the readings."""

from __future__ import annotations

import os
import shutil

import duckdb

from tests.oracle import TABLES


def write(source: str, target: str) -> str:
    os.makedirs(target, exist_ok=True)
    for table in TABLES:
        if table != "events":
            shutil.copyfile(f"{source}/{table}.parquet", f"{target}/{table}.parquet")
    # Ids stay unique; the residue 13 puts user 7 on the first sensor.
    duckdb.sql(f"""
        COPY (
          SELECT event_id * 17 + CASE WHEN hot THEN 13 ELSE event_id % 17 END AS event_id,
                 CASE WHEN hot THEN TIMESTAMP '2024-01-15 10:00:00' + to_microseconds(event_id * 150000) ELSE ts END AS ts,
                 CASE WHEN hot THEN 7 ELSE user_id END AS user_id, event_type, value, props
          FROM (SELECT *, event_id % 3 = 0 AS hot FROM read_parquet('{source}/events.parquet')))
        TO '{target}/events.parquet' (FORMAT parquet)""")
    return target
