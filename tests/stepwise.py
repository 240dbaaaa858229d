"""Stepwise oracle: the merge statements run one at a time in DuckDB.

This is the reference's order of statements (type-1 update, expire, insert,
soft delete, reactivate), each its own UPDATE/INSERT over the table left by
the previous one. The one-pass Spark merges must end in the same table.
"""

from __future__ import annotations

import duckdb
import pandas as pd

RUN = "TIMESTAMP '2024-02-01 00:00:00'"


def _changed(cols, text_cols, d="d.", o="o."):
    parts = [f"COALESCE({d}{c}, '') <> COALESCE({o}{c}, '')" if c in text_cols
             else f"{d}{c} IS DISTINCT FROM {o}{c}" for c in cols]
    return "(" + " OR ".join(parts) + ")" if parts else "FALSE"


def run(dim: pd.DataFrame, stg: pd.DataFrame, keys, type1, type2, text_cols, sk,
        close_on_delete=False) -> tuple[pd.DataFrame, dict]:
    con = duckdb.connect()
    con.register("dim_in", dim)
    con.register("stg_in", stg)
    con.execute("CREATE TABLE d AS SELECT * FROM dim_in")
    con.execute("CREATE TABLE o AS SELECT * FROM stg_in")
    on = " AND ".join(f"d.{k} = o.{k}" for k in keys)
    counts = {}
    if type1:
        sets = ", ".join(f"{c} = o.{c}" for c in type1)
        counts["Updated_Count"] = con.execute(
            f"UPDATE d SET {sets}, Updated_Datetime = {RUN} FROM o WHERE {on} AND "
            f"{_changed(type1, text_cols)}").fetchone()[0]
    else:
        counts["Updated_Count"] = 0
    scd2 = bool(type2)
    if scd2:
        counts["Expired_Count"] = con.execute(
            f"UPDATE d SET Row_Is_Current = 0, Row_Expiry_Datetime = {RUN}, Updated_Datetime = {RUN} "
            f"FROM o WHERE {on} AND d.Row_Is_Current = 1 AND {_changed(type2, text_cols)}").fetchone()[0]
        block = f"SELECT 1 FROM d WHERE {on} AND d.Row_Is_Current = 1"
    else:
        counts["Expired_Count"] = 0
        block = f"SELECT 1 FROM d WHERE {on}"
    cols = list(keys) + list(type1) + list(type2)
    order = ", ".join(f"o.{k}" for k in keys)
    extra = f", 1, {RUN}, NULL" if scd2 else ""
    extra_cols = ", Row_Is_Current, Row_Effective_Datetime, Row_Expiry_Datetime" if scd2 else ""
    counts["Inserted_Count"] = con.execute(
        f"INSERT INTO d ({sk}, {', '.join(cols)}, Inserted_Datetime, Updated_Datetime, Is_Deleted, "
        f"Row_Change_Reason{extra_cols}) "
        f"SELECT (SELECT COALESCE(MAX({sk}), 0) FROM d) + row_number() OVER (ORDER BY {order}), "
        f"{', '.join('o.' + c for c in cols)}, {RUN}, NULL, 0, 'NEW'{extra} "
        f"FROM o WHERE NOT EXISTS ({block})").fetchone()[0]
    cur = " AND Row_Is_Current = 1" if scd2 else ""
    close = ", Row_Is_Current = 0" if close_on_delete else ""
    expiry = f", Row_Expiry_Datetime = {RUN}" if scd2 else ""
    on_k = " AND ".join(f"o.{k} = d.{k}" for k in keys)
    counts["Deleted_Count"] = con.execute(
        f"UPDATE d SET Is_Deleted = 1{expiry}{close}, Updated_Datetime = {RUN}, "
        f"Row_Change_Reason = 'Soft Deleted' WHERE NOT EXISTS (SELECT 1 FROM o WHERE {on_k}) "
        f"AND Is_Deleted = 0{cur}").fetchone()[0]
    counts["Reactivated_Count"] = con.execute(
        f"UPDATE d SET Is_Deleted = 0, Updated_Datetime = {RUN}, Row_Change_Reason = 'Reactivated' "
        f"WHERE EXISTS (SELECT 1 FROM o WHERE {on_k}) AND Is_Deleted = 1").fetchone()[0]
    out = con.execute("SELECT * FROM d").fetchdf()
    return out, counts
