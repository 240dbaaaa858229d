"""Oracle SQL (DuckDB dialect) for the registered queries.

Each string runs on the pre-registered views of the test tables and must give
the same rows as the Spark query of the same name. The merges are written
here as plain SQL over CTEs: the same derivation of staging and dimension,
then the merge semantics spelled out as joins and CASE expressions. The text
is assembled from the same specs the Spark side uses.
"""

from __future__ import annotations

from dimkiln.functions.text import SANITIZE_PATTERN
from dimkiln.plans import scenarios as S
from dimkiln.spec import (EFFECTIVE, EXPIRY, INSERTED, IS_CURRENT, IS_DELETED, REASON,
                          UPDATED, DimensionSpec)


def tsql(value: str) -> str:
    return f"TIMESTAMP '{value}'"


RUN = tsql(S.T1)
NULL_TS = "CAST(NULL AS TIMESTAMP)"

CUSTOMER_TEXT = {"c_name", "c_mktsegment"}

# --- scenario CTEs ------------------------------------------------------------

CUSTOMER_STG = "stg AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment " \
               "FROM customer WHERE c_custkey % 13 <> 0)"

_CUSTOMER_BASE = f"""base AS (
  SELECT c_custkey * 2 + 2 AS Customer_SK, c_custkey, c_name, c_nationkey,
         CASE WHEN c_custkey % 7 = 0 THEN c_acctbal - 1 ELSE c_acctbal END AS c_acctbal,
         CASE WHEN c_custkey % 9 = 0 THEN 'OLD' ELSE c_mktsegment END AS c_mktsegment,
         {tsql(S.T0)} AS {INSERTED}, {NULL_TS} AS {UPDATED},
         CASE WHEN c_custkey % 11 = 0 THEN 1 ELSE 0 END AS {IS_DELETED},
         'NEW' AS {REASON}
  FROM customer WHERE c_custkey % 5 <> 0)"""

CUSTOMER_DIM1 = _CUSTOMER_BASE + ",\ndim AS (SELECT * FROM base)"

CUSTOMER_DIM2 = _CUSTOMER_BASE + f""",
dim AS (
  SELECT *, 1 AS {IS_CURRENT}, {tsql(S.T0)} AS {EFFECTIVE}, {NULL_TS} AS {EXPIRY} FROM base
  UNION ALL
  SELECT Customer_SK - 1, c_custkey, c_name, c_nationkey, c_acctbal, 'H',
         {tsql(S.T_HIST)}, {tsql(S.T0)}, 0, {REASON},
         0, {tsql(S.T_HIST)}, {tsql(S.T0)}
  FROM base WHERE c_custkey % 4 = 0)"""


# --- merge semantics as SQL ----------------------------------------------------

def _changed(cols, text_cols, d="", o="o_") -> str:
    parts = []
    for c in cols:
        if c in text_cols:
            parts.append(f"COALESCE({d}{c}, '') <> COALESCE({o}{c}, '')")
        else:
            parts.append(f"{d}{c} IS DISTINCT FROM {o}{c}")
    return "(" + " OR ".join(parts) + ")" if parts else "FALSE"


def dim_columns(spec: DimensionSpec) -> list[str]:
    return [spec.sk, *spec.columns, *spec.audit_columns()]


def merge_ctes(spec: DimensionSpec, text_cols: set[str], run: str = RUN,
               close_on_delete: bool = False, soft_delete: bool = True) -> str:
    """CTEs ``kept`` and ``ins`` (with flag columns u, e, x, r) over ``dim`` and ``stg``."""
    on = " AND ".join(f"d.{k} = o.{k}" for k in spec.keys)
    o_cols = ", ".join(f"o.{c} AS o_{c}" for c in spec.columns)
    scd2 = spec.is_scd2
    cur = f"{IS_CURRENT} = 1" if scd2 else "TRUE"
    u = f"hit AND {_changed(spec.type1, text_cols)}"
    e = f"hit AND {cur} AND {_changed(spec.type2, text_cols)}" if scd2 else "FALSE"
    x = f"NOT hit AND {cur} AND {IS_DELETED} = 0" if soft_delete else "FALSE"
    r = f"hit AND {IS_DELETED} = 1"
    sets = {c: f"CASE WHEN u THEN o_{c} ELSE {c} END" for c in spec.type1}
    sets[UPDATED] = f"CASE WHEN u OR e OR x OR r THEN {run} ELSE {UPDATED} END"
    sets[IS_DELETED] = f"CASE WHEN x THEN 1 WHEN r THEN 0 ELSE {IS_DELETED} END"
    sets[REASON] = (f"CASE WHEN x THEN 'Soft Deleted' WHEN r THEN 'Reactivated' "
                    f"ELSE {REASON} END")
    if scd2:
        closes = "e OR x" if close_on_delete else "e"
        sets[IS_CURRENT] = f"CASE WHEN {closes} THEN 0 ELSE {IS_CURRENT} END"
        sets[EXPIRY] = f"CASE WHEN e OR x THEN {run} ELSE {EXPIRY} END"
    kept_cols = ", ".join(f"{sets[c]} AS {c}" if c in sets else c for c in dim_columns(spec))
    if scd2:
        block = (f"SELECT 1 FROM dim d WHERE {on} AND d.{IS_CURRENT} = 1 AND NOT "
                 f"{_changed(spec.type2, text_cols, 'd.', 'o.')}")
    else:
        block = f"SELECT 1 FROM dim d WHERE {on}"
    order = ", ".join(f"o.{k}" for k in spec.keys)
    ins_audit = f"{run} AS {INSERTED}, {NULL_TS} AS {UPDATED}, 0 AS {IS_DELETED}, 'NEW' AS {REASON}"
    if scd2:
        ins_audit += f", 1 AS {IS_CURRENT}, {run} AS {EFFECTIVE}, {NULL_TS} AS {EXPIRY}"
    ins_cols = ", ".join(f"o.{c} AS {c}" for c in spec.columns)
    return f"""j AS (
  SELECT d.*, {o_cols}, COALESCE(o.o_hit, FALSE) AS hit
  FROM dim d LEFT JOIN (SELECT *, TRUE AS o_hit FROM stg) o ON {on}),
f AS (SELECT *, {u} AS u, {e} AS e, {x} AS x, {r} AS r FROM j),
kept AS (SELECT {kept_cols}, u, e, x, r FROM f),
ins AS (
  SELECT (SELECT COALESCE(MAX({spec.sk}), 0) FROM dim) + row_number() OVER (ORDER BY {order})
           AS {spec.sk},
         {ins_cols}, {ins_audit}
  FROM stg o WHERE NOT EXISTS ({block}))"""


def merged_select(spec: DimensionSpec) -> str:
    cols = ", ".join(dim_columns(spec))
    return f"SELECT {cols} FROM kept UNION ALL SELECT {cols} FROM ins"


COUNTS_SELECT = """SELECT (SELECT count(*) FROM ins) AS Inserted_Count,
       count(*) FILTER (WHERE u) AS Updated_Count,
       count(*) FILTER (WHERE x) AS Deleted_Count,
       count(*) FILTER (WHERE r) AS Reactivated_Count,
       count(*) FILTER (WHERE e) AS Expired_Count
FROM kept"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# --- lineitem de-duplication ---------------------------------------------------

LINEITEM_TEXT = {"l_returnflag", "l_linestatus"}
_LI_KEYS = ", ".join(S.LINEITEM_KEYS)
_LI_ORDER = ", ".join(f"{c} NULLS FIRST" for c in S.LINEITEM_ORDER)

LINEITEM_RANKED = f"""ranked AS (
  SELECT *, count(*) OVER (PARTITION BY {_LI_KEYS}) AS dup_count,
         row_number() OVER (PARTITION BY {_LI_KEYS} ORDER BY {_LI_ORDER}) AS rn
  FROM lineitem)"""

LINEITEM_DEDUP = "dedup AS (SELECT * EXCLUDE (dup_count, rn) FROM ranked WHERE rn = 1)"

LINEITEM_DUPS = "dups AS (SELECT * EXCLUDE (rn), rn = 1 AS was_kept FROM ranked WHERE dup_count > 1)"

LINEITEM_STG = "stg AS (SELECT * FROM dedup WHERE l_orderkey % 7 <> 0)"

LINEITEM_DIM = f"""dim AS (
  SELECT CAST(l_orderkey * 8 + l_linenumber AS BIGINT) AS LineItem_SK, l_orderkey, l_linenumber,
         l_partkey, l_suppkey,
         CASE WHEN l_linenumber = 2 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity,
         l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate,
         {tsql(S.T0)} AS {INSERTED}, {NULL_TS} AS {UPDATED},
         CASE WHEN l_orderkey % 11 = 0 THEN 1 ELSE 0 END AS {IS_DELETED}, 'NEW' AS {REASON}
  FROM dedup WHERE l_orderkey % 3 <> 0)"""


# --- typed load -------------------------------------------------------------------

_DUCK_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "smallint": "SMALLINT", "double": "DOUBLE",
               "float": "FLOAT", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "string": "VARCHAR"}


def duck_type(spark_type: str) -> str:
    return spark_type.upper() if spark_type.startswith("decimal") else _DUCK_TYPES[spark_type]


def typed_value_sql(c: str, declared: str) -> str:
    from dimkiln.functions.types import parse_declared
    dt = parse_declared(declared)
    if dt.spark_type == "string":
        return c
    inner = f"NULLIF(trim({c}), '')"
    if dt.is_bit:
        return f"CAST(TRY_CAST({inner} AS BOOLEAN) AS INTEGER)"
    return f"TRY_CAST({inner} AS {duck_type(dt.spark_type)})"


def typed_reason_sql(spec: DimensionSpec) -> str:
    from dimkiln.functions.types import parse_declared
    q = "'"
    parts = []
    for c in spec.columns:
        dt = parse_declared(spec.types.get(c, "VARCHAR(8000)"))
        blank = f"({c} IS NULL OR trim({c}) = '')"
        if c in spec.keys:
            parts.append(f"CASE WHEN {blank} THEN 'NULL_KEY: {c}' END")
        elif c in spec.required:
            parts.append(f"CASE WHEN {blank} THEN 'MISSING_REQUIRED: {c}' END")
        if dt.spark_type == "string":
            if dt.max_length is not None:
                parts.append(f"CASE WHEN length({c}) > {dt.max_length} "
                             f"THEN 'TOO_LONG: {c} > {dt.max_length}' END")
        else:
            msg_head = f"{q}TYPE_ERROR: {c}={q*3}"
            msg_tail = f"{q*3} is not {dt.declared.upper()}{q}"
            parts.append(f"CASE WHEN NOT {blank} AND {typed_value_sql(c, dt.declared)} IS NULL "
                         f"THEN {msg_head} || {c} || {msg_tail} END")
    return "NULLIF(concat_ws('; ', " + ", ".join(parts) + "), '')"


PART_RAW = """raw AS (
  SELECT CASE WHEN p_partkey % 31 = 0 THEN NULL ELSE CAST(p_partkey AS VARCHAR) END AS p_partkey,
         CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE p_name END AS p_name,
         CASE WHEN p_partkey % 23 = 0 THEN p_brand || '-EXTENDED' ELSE p_brand END AS p_brand,
         p_type,
         CASE WHEN p_partkey % 17 = 0 THEN CAST(p_size AS VARCHAR) || 'x'
              ELSE CAST(p_size AS VARCHAR) END AS p_size,
         CASE WHEN p_partkey % 29 = 0 THEN 'n/a' ELSE CAST(p_retailprice AS VARCHAR) END AS p_retailprice
  FROM part)"""


def part_checked() -> str:
    return f"chk AS (SELECT *, {typed_reason_sql(S.PART_SPEC)} AS reasons FROM raw)"


def part_typed_select() -> str:
    spec = S.PART_SPEC
    cols = ", ".join(f"{typed_value_sql(c, spec.types[c])} AS {c}" for c in spec.columns)
    return f"SELECT {cols} FROM chk WHERE reasons IS NULL"


SANITIZE_SQL = (f"SELECT doc_id, trim(regexp_replace(text, '{SANITIZE_PATTERN}', ' ', 'g')) AS text "
                f"FROM documents")


# --- source metadata -------------------------------------------------------------

def flag_sql(c: str) -> str:
    return f"COALESCE(TRY_CAST(trim(CAST({c} AS VARCHAR)) AS DOUBLE) = 1, FALSE)"


def _sources_cte() -> str:
    sys_rows = "\n  ".join(
        f"UNION ALL SELECT {sk}, '{n}', 'config/{n}', '*.xlsx', '{n}', '[ETL].[{n}]', '{order}', "
        f"'{active}', '0', '[ETL].[Dim_{n}]', NULL, '0'"
        for sk, n, order, active in S.SYSTEM_ROWS)
    return f"""src AS (
  SELECT CAST(s_suppkey + 1 AS BIGINT) AS Source_Import_SK, s_name AS Source_Name,
         'raw/' || s_name AS Rel_Path, '*.parquet' AS Pattern, CAST(NULL AS VARCHAR) AS Sheet_Name,
         '[ODS].[' || s_name || ']' AS Staging_Table,
         CAST(s_nationkey AS VARCHAR) || '.5' AS Processing_Order,
         CASE WHEN s_acctbal >= 0 THEN '1' ELSE '0' END AS Is_Active,
         CASE WHEN s_nationkey = 7 THEN '1' ELSE '0' END AS Is_Deleted,
         '[DW].[Dim_' || s_name || ']' AS DW_Table_Name,
         CASE WHEN s_nationkey = 5 THEN NULL ELSE '[ETL].[SP_Merge_Dim_' || s_name || ']' END
           AS Merge_Proc_Name,
         CASE WHEN s_nationkey = 3 THEN '1' ELSE '0' END AS Force_DDL_Generation
  FROM supplier
  {sys_rows})"""


SOURCES = _sources_cte()
PROC_ORDER = "TRY_CAST(trim(Processing_Order) AS DECIMAL(9,3))"
MERGE_PROC = ("CASE WHEN trim(COALESCE(Merge_Proc_Name, '')) = '' THEN 'ETL.SP_Merge_Dim_' || "
              "Source_Name ELSE Merge_Proc_Name END")
CONFIG_SOURCES = ("cand AS (SELECT DISTINCT Source_Name FROM src WHERE " + flag_sql("Is_Active")
                  + " AND Source_Name NOT IN ('Source_Imports', 'Source_File_Mapping'))")


def mapping_snapshot_cte(name: str, lo: str | None, hi: str | None) -> str:
    conds = []
    if lo:
        conds.append(f"l_shipdate >= {tsql(lo)}")
    if hi:
        conds.append(f"l_shipdate < {tsql(hi)}")
    where = ("WHERE " + " AND ".join(conds)) if conds else ""
    return f"""{name} AS (
  SELECT 'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS Source_Name,
         'Line ' || CAST(l_linenumber AS VARCHAR) AS Source_Column,
         'Line_' || CAST(l_linenumber AS VARCHAR) AS Target_Column,
         CASE WHEN max(l_quantity) >= 49 THEN 'DECIMAL(12,2)' ELSE 'INT' END AS Data_Type,
         CASE WHEN count(*) = 1 THEN NULL ELSE 'lines ' || CAST(count(*) AS VARCHAR) END AS Description,
         CASE WHEN l_linenumber = 1 THEN '1' ELSE '0' END AS Is_PK,
         CASE WHEN l_linenumber = 7 THEN '1' ELSE '0' END AS Is_Type2_Attribute,
         CASE WHEN l_linenumber <= 2 THEN '1' ELSE '0' END AS Is_Required,
         max(l_shipdate) AS Inserted_Datetime,
         l_suppkey AS _suppkey, l_linenumber AS _line, min(l_discount) AS _min_discount
  FROM lineitem {where}
  GROUP BY l_suppkey, l_linenumber)"""


def _p03(c: str) -> str:
    from dimkiln.functions.text import WS_RUN_PATTERN
    return f"COALESCE(trim(regexp_replace({c}, '{WS_RUN_PATTERN}', ' ', 'g')), '')"


MAPPING_KNOWN = ("Source_Name", "Source_Column", "Target_Column", "Data_Type", "Description",
                 "Is_Type2_Attribute", "Is_PK", "Is_Required")

MAPPING_STG = (mapping_snapshot_cte("m_new", S.MAPPING_NEW_FROM, None) + ",\nstg AS (SELECT "
               + ", ".join(f"{_p03(c)} AS {c}" for c in MAPPING_KNOWN)
               + ", Inserted_Datetime FROM m_new)")

MAPPING_DIM = (mapping_snapshot_cte("m_old", None, S.MAPPING_OLD_BEFORE) + f""",
dim AS (
  SELECT CAST(_suppkey * 8 + _line AS BIGINT) AS File_Mapping_SK, """
               + ", ".join(f"COALESCE({c}, '') AS {c}" for c in S.MAPPING_SPEC.columns) + f""",
         {tsql(S.T0)} AS {INSERTED}, {NULL_TS} AS {UPDATED},
         CASE WHEN _min_discount = 0 THEN 1 ELSE 0 END AS {IS_DELETED}, 'NEW' AS {REASON},
         1 AS {IS_CURRENT}, {tsql(S.T0)} AS {EFFECTIVE}, {NULL_TS} AS {EXPIRY}
  FROM m_old)""")

LAST_CHECKED = """chk AS (
  SELECT 'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS Source_Name,
         max(l_shipdate) AS Last_Checked
  FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)"""


# --- facts ---------------------------------------------------------------------------

def dec_sum(c: str) -> str:
    return f"CAST(sum(CAST({c} AS DECIMAL(18,2))) AS DECIMAL(38,2))"


FACT_SUMS = (f"{dec_sum('l_quantity')} AS Sum_Quantity, "
             f"{dec_sum('l_extendedprice')} AS Sum_Extended_Price, count(*) AS Row_Count")

LINE_RULES = {
    "quantity_not_positive": "l_quantity > 0",
    "price_not_positive": "l_extendedprice > 0",
    "discount_out_of_range": f"l_discount >= 0 AND l_discount <= {S.MAX_DISCOUNT}",
    "tax_out_of_range": f"l_tax >= 0 AND l_tax <= {S.MAX_TAX}",
}
LINE_REASON = ("NULLIF(concat_ws(', ', " + ", ".join(
    f"CASE WHEN NOT COALESCE({rule}, FALSE) THEN '{name}' END" for name, rule in LINE_RULES.items())
    + "), '')")


# --- orders as a Type 2 dimension ----------------------------------------------------

ORDERS_TEXT = {"o_orderpriority", "o_orderstatus"}
ORDERS_STG = ("stg AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, "
              "o_orderstatus FROM orders WHERE o_orderkey % 13 <> 0)")
ORDERS_DIM2 = f"""obase AS (
  SELECT o_orderkey * 2 + 2 AS Orders_SK, o_orderkey, o_custkey,
         CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice - 1 ELSE o_totalprice END AS o_totalprice,
         o_orderdate, o_orderpriority,
         CASE WHEN o_orderkey % 9 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
         {tsql(S.T0)} AS {INSERTED}, {NULL_TS} AS {UPDATED},
         CASE WHEN o_orderkey % 11 = 0 THEN 1 ELSE 0 END AS {IS_DELETED}, 'NEW' AS {REASON}
  FROM orders WHERE o_orderkey % 5 <> 0),
dim AS (
  SELECT *, 1 AS {IS_CURRENT}, {tsql(S.T0)} AS {EFFECTIVE}, {NULL_TS} AS {EXPIRY} FROM obase
  UNION ALL
  SELECT Orders_SK - 1, o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, 'H',
         {tsql(S.T_HIST)}, {tsql(S.T0)}, 0, {REASON}, 0, {tsql(S.T_HIST)}, {tsql(S.T0)}
  FROM obase WHERE o_orderkey % 4 = 0)"""
