"""Registered queries: one per operator of the survey inventory.

Each query takes ``(spark, sf_dir)``, reads whole tables from ``sf_dir`` and
returns a DataFrame; ``ORACLE`` holds the DuckDB SQL giving the same rows.
Queries that write tables put them under the session's warehouse folder.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimkiln.functions import flags as FL
from dimkiln.functions import text as TX
from dimkiln.operators import audit as AU
from dimkiln.operators import dedup as D
from dimkiln.operators import evolve as EV
from dimkiln.operators import facts as FX
from dimkiln.operators import keys as K
from dimkiln.operators import metadata as M
from dimkiln.operators import scd
from dimkiln.operators import typed_load as TL
from dimkiln.plans import oracle as Q
from dimkiln.plans import pipeline as PL
from dimkiln.plans import scenarios as S
from dimkiln.session import table_dir, write_shared
from dimkiln.sinks import store
from dimkiln.sinks.buckets import BucketTable
from dimkiln.sources import bulk_log as BL
from dimkiln.sources import files as SRC
from dimkiln.spec import DimensionSpec

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --- dimension merges on customer (M-01, M-02, M-05, J-01..J-04, F-05, M-08) ---

def _customer(spark, sf):
    c = S.read(spark, sf, "customer")
    return S.customer_staging(c), c


def scd1_result(spark, sf) -> scd.MergeResult:
    stg, c = _customer(spark, sf)
    return scd.scd1_merge(S.customer_dim_scd1(c), stg, S.CUSTOMER_SCD1, S.T1)


def scd2_result(spark, sf) -> scd.MergeResult:
    stg, c = _customer(spark, sf)
    return scd.scd2_merge(S.customer_dim_scd2(c), stg, S.CUSTOMER_SCD2, S.T1)


_SCD1_CTES = Q.with_(Q.CUSTOMER_STG, Q.CUSTOMER_DIM1,
                     Q.merge_ctes(S.CUSTOMER_SCD1, Q.CUSTOMER_TEXT))
_SCD2_CTES = Q.with_(Q.CUSTOMER_STG, Q.CUSTOMER_DIM2,
                     Q.merge_ctes(S.CUSTOMER_SCD2, Q.CUSTOMER_TEXT))


@query("scd1_merge", _SCD1_CTES + Q.merged_select(S.CUSTOMER_SCD1))
def q_scd1_merge(spark, sf):
    return scd1_result(spark, sf).rows


@query("merge_counts", _SCD1_CTES + Q.COUNTS_SELECT)
def q_merge_counts(spark, sf):
    return scd1_result(spark, sf).counts()


@query("scd2_merge", _SCD2_CTES + Q.merged_select(S.CUSTOMER_SCD2))
def q_scd2_merge(spark, sf):
    return scd2_result(spark, sf).rows


@query("scd2_merge_counts", _SCD2_CTES + Q.COUNTS_SELECT)
def q_scd2_merge_counts(spark, sf):
    return scd2_result(spark, sf).counts()


@query("current_rows", _SCD2_CTES + "SELECT * FROM (" + Q.merged_select(S.CUSTOMER_SCD2)
       + ") m WHERE Is_Deleted = 0 AND Row_Is_Current = 1")
def q_current_rows(spark, sf):
    return scd.current_rows(scd2_result(spark, sf).rows, scd2=True)


@query("active_key_violations", _SCD2_CTES + """SELECT c_custkey, count(*) AS active_rows
FROM (SELECT c_custkey, Is_Deleted, Row_Is_Current FROM dim
      UNION ALL SELECT c_custkey, Is_Deleted, Row_Is_Current FROM ins) a
WHERE Is_Deleted = 0 AND Row_Is_Current = 1
GROUP BY c_custkey HAVING count(*) > 1""")
def q_active_key_violations(spark, sf):
    """M-08 on a load that inserted new versions but skipped the expiry step."""
    stg, c = _customer(spark, sf)
    dim = S.customer_dim_scd2(c)
    res = scd.scd2_merge(dim, stg, S.CUSTOMER_SCD2, S.T1)
    broken = dim.unionByName(res.inserts.drop(*scd.FLAGS))
    return K.active_key_violations(broken, S.CUSTOMER_SCD2.keys, scd2=True)


_DIM1_ONLY = Q.with_(Q.CUSTOMER_STG, Q.CUSTOMER_DIM1)


@query("new_rows", _DIM1_ONLY + "SELECT o.* FROM stg o WHERE NOT EXISTS "
       "(SELECT 1 FROM dim d WHERE d.c_custkey = o.c_custkey)")
def q_new_rows(spark, sf):
    stg, c = _customer(spark, sf)
    return scd.new_rows(S.customer_dim_scd1(c), stg, S.CUSTOMER_SCD1.keys)


@query("missing_rows", _DIM1_ONLY + "SELECT d.* FROM dim d WHERE NOT EXISTS "
       "(SELECT 1 FROM stg o WHERE d.c_custkey = o.c_custkey)")
def q_missing_rows(spark, sf):
    stg, c = _customer(spark, sf)
    return scd.missing_rows(S.customer_dim_scd1(c), stg, S.CUSTOMER_SCD1.keys)


@query("reappeared_rows", _DIM1_ONLY + "SELECT d.* FROM dim d WHERE d.Is_Deleted = 1 AND "
       "EXISTS (SELECT 1 FROM stg o WHERE d.c_custkey = o.c_custkey)")
def q_reappeared_rows(spark, sf):
    stg, c = _customer(spark, sf)
    return scd.reappeared_rows(S.customer_dim_scd1(c), stg, S.CUSTOMER_SCD1.keys)


@query("changed_rows", _DIM1_ONLY + "SELECT d.Customer_SK, d.c_custkey, "
       + ", ".join(f"d.{c} AS old_{c}" for c in S.CUSTOMER_SCD1.type1) + ", "
       + ", ".join(f"o.{c} AS new_{c}" for c in S.CUSTOMER_SCD1.type1)
       + " FROM dim d JOIN stg o ON d.c_custkey = o.c_custkey WHERE "
       + Q._changed(S.CUSTOMER_SCD1.type1, Q.CUSTOMER_TEXT, "d.", "o."))
def q_changed_rows(spark, sf):
    stg, c = _customer(spark, sf)
    return scd.changed_rows(S.customer_dim_scd1(c), stg, S.CUSTOMER_SCD1)


# --- de-duplication and rejects on lineitem (W-01, W-02, A-07, K-04, A-03) ---------


_LI_DUPS = Q.with_(Q.LINEITEM_RANKED, Q.LINEITEM_DUPS)


def _lineitem(spark, sf):
    return S.read(spark, sf, "lineitem")


def lineitem_dedup(spark, sf):
    return D.dedup_first(_lineitem(spark, sf), S.LINEITEM_KEYS, S.LINEITEM_ORDER)


@query("dedup_first", Q.with_(Q.LINEITEM_RANKED, Q.LINEITEM_DEDUP) + "SELECT * FROM dedup")
def q_dedup_first(spark, sf):
    return lineitem_dedup(spark, sf)


@query("duplicate_rows", _LI_DUPS + "SELECT * FROM dups")
def q_duplicate_rows(spark, sf):
    return D.duplicate_rows(_lineitem(spark, sf), S.LINEITEM_KEYS, S.LINEITEM_ORDER)


def lineitem_rejects(spark, sf):
    li = SRC.with_lineage(_lineitem(spark, sf))
    raw = [c for c in li.columns if not c.startswith("_")]
    dups = D.duplicate_rows(li, S.LINEITEM_KEYS, [SRC.FILE_PATH, SRC.ROW_NUMBER])
    return D.reject_rows(dups, S.LINEITEM_KEYS, "lineitem", 1, raw,
                         file_col=SRC.FILE_NAME, row_col=SRC.ROW_NUMBER)


_LI_RAW = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
           "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")

# rows of the view come in file order, which is what "first" means
_LI_FILE_ORDER = """numbered AS (SELECT *, row_number() OVER () + 1 AS file_row FROM lineitem),
dups AS (SELECT * FROM (
  SELECT *, count(*) OVER k AS dup_count, row_number() OVER (k ORDER BY file_row) = 1 AS was_kept
  FROM numbered WINDOW k AS (PARTITION BY l_orderkey, l_linenumber)) r WHERE dup_count > 1)"""

_REJECT_SQL = Q.with_(_LI_FILE_ORDER) + """SELECT CAST(1 AS BIGINT) AS Audit_Source_Import_SK,
  'lineitem' AS Source_Name, 'lineitem.parquet' AS File_Name, file_row AS Row_Number,
  'DUPLICATE_RECORD: PK l_orderkey=' || CAST(l_orderkey AS VARCHAR) || ', l_linenumber='
    || CAST(l_linenumber AS VARCHAR) AS Rejected_Reason,
  was_kept, """ + ", ".join(f"{c} AS raw_{c}" for c in _LI_RAW) + " FROM dups"


@query("reject_rows", _REJECT_SQL)
def q_reject_rows(spark, sf):
    """K-04; the raw JSON is compared through all fields read back out of it."""
    r = lineitem_rejects(spark, sf)
    kinds = dict(_lineitem(spark, sf).dtypes)
    fields = F.from_json("Raw_Data", ", ".join(f"{c} {kinds[c]}" for c in _LI_RAW)).alias("raw")
    return (r.select("Audit_Source_Import_SK", "Source_Name", "File_Name", "Row_Number", "Rejected_Reason",
                     "was_kept", fields)
            .select("Audit_Source_Import_SK", "Source_Name", "File_Name", "Row_Number", "Rejected_Reason",
                    "was_kept", *[F.col(f"raw.{c}").alias(f"raw_{c}") for c in _LI_RAW]))


@query("reject_counts", "SELECT Source_Name, Audit_Source_Import_SK, count(*) AS Rejected_Count "
       "FROM (" + _REJECT_SQL + ") r GROUP BY 1, 2")
def q_reject_counts(spark, sf):
    """A-03 from key counts: only keys are shuffled."""
    return D.duplicate_reject_counts(_lineitem(spark, sf), S.LINEITEM_KEYS, "lineitem", 1)


@query("row_lineage", "SELECT l_orderkey, l_linenumber, 'lineitem.parquet' AS _file_name, "
       "row_number() OVER () + 1 AS _row_number FROM lineitem")
def q_row_lineage(spark, sf):
    """S-05: file name and sheet-style row number of every lineitem row."""
    return SRC.with_lineage(_lineitem(spark, sf)).select(
        *S.LINEITEM_KEYS, SRC.FILE_NAME, SRC.ROW_NUMBER)


_TABLES = ("region nation customer supplier part orders lineitem events documents "
           "embeddings pages benchmark labels conversations").split()


def all_files_lineage(spark, sf):
    frames = [SRC.with_lineage(S.read(spark, sf, t)).select(SRC.FILE_NAME, SRC.FILE_PATH)
              for t in _TABLES]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@query("file_lineage", " UNION ALL ".join(
    f"SELECT '{t}.parquet' AS Original_File_Name, count(*) AS File_Row_Count, "
    f"'Success' AS Process_Status FROM {t}" for t in _TABLES))
def q_file_lineage(spark, sf):
    """K-08: one lineage row per file read, with its row count."""
    from dimkiln.operators.audit import file_lineage
    return file_lineage(all_files_lineage(spark, sf)).select(
        "Original_File_Name", "File_Row_Count", "Process_Status")


@query("run_totals", "SELECT sum(n) AS Total_Row_Count, count(*) AS Total_File_Count FROM ("
       + " UNION ALL ".join(f"SELECT count(*) AS n FROM {t}" for t in _TABLES) + ") t")
def q_run_totals(spark, sf):
    """A-05: total rows and distinct files of a run."""
    from dimkiln.operators.audit import run_totals
    return run_totals(all_files_lineage(spark, sf))


# --- typed load of part text (K-02, M-09, P-08, D-14) --------------------------------

def part_load(spark, sf) -> TL.TypedLoad:
    return TL.split(S.part_raw_text(S.read(spark, sf, "part")), S.PART_SPEC)


@query("typed_load", Q.with_(Q.PART_RAW, Q.part_checked()) + Q.part_typed_select())
def q_typed_load(spark, sf):
    return part_load(spark, sf).good


@query("typed_load_rejects", Q.with_(Q.PART_RAW, Q.part_checked())
       + "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice, "
         "reasons AS Rejected_Reason FROM chk WHERE reasons IS NOT NULL")
def q_typed_load_rejects(spark, sf):
    return part_load(spark, sf).rejects


@query("flag_parse", """SELECT event_id, flag_text,
  COALESCE(TRY_CAST(trim(flag_text) AS DOUBLE) = 1, FALSE) AS is_flag
FROM (SELECT event_id, CASE WHEN value < 5 THEN '0' WHEN event_type = 'click' THEN '1'
      WHEN event_type = 'view' THEN ' 1 ' WHEN event_type = 'purchase' THEN '1.0'
      WHEN event_type = 'signup' THEN 'True' ELSE '' END AS flag_text FROM events) e""")
def q_flag_parse(spark, sf):
    t = S.event_flag_text(S.read(spark, sf, "events"))
    return t.select("event_id", "flag_text", FL.parse_flag("flag_text").alias("is_flag"))


@query("sanitize_text", Q.SANITIZE_SQL)
def q_sanitize_text(spark, sf):
    """P-01 + P-02 over whole document texts."""
    d = S.read(spark, sf, "documents")
    return d.select("doc_id", TX.sanitize("text").alias("text"))


# --- surrogate keys and composite keys (M-10, M-03, J-06) ------------------------------

@query("assign_sk", "SELECT *, row_number() OVER (ORDER BY c_custkey) AS Customer_SK FROM customer")
def q_assign_sk(spark, sf):
    return K.assign_sk(S.read(spark, sf, "customer"), ["c_custkey"], "Customer_SK")


_COMPOSITE_CTES = Q.with_(Q.LINEITEM_RANKED, Q.LINEITEM_DEDUP, Q.LINEITEM_STG, Q.LINEITEM_DIM,
                          Q.merge_ctes(S.LINEITEM_SCD1, Q.LINEITEM_TEXT, soft_delete=False))


@query("scd1_composite", _COMPOSITE_CTES + Q.merged_select(S.LINEITEM_SCD1))
def q_scd1_composite(spark, sf):
    """M-03/J-06: Type 1 merge on a two-column key, no soft delete."""
    # staging is written once and read by both sides of the merge, as a load does
    d = write_shared(lineitem_dedup(spark, sf), "lineitem-staging")
    return scd.scd1_merge(S.lineitem_dim(d), S.lineitem_staging(d), S.LINEITEM_SCD1, S.T1,
                          soft_delete=False).rows


# --- source metadata (F-01, F-02, A-01, A-02, A-06, C-01, J-05, M-04, P-03, P-05, P-06) ------


def _sources(spark, sf):
    return S.sources_from_supplier(S.read(spark, sf, "supplier"))


def mapping_stage(spark, sf):
    """Today's mapping sheet after P-03 trimming and P-06 known columns."""
    return M.known_columns(M.trim_mapping(S.mapping_staging(_lineitem(spark, sf))))


@query("active_sources", Q.with_(Q.SOURCES) + f"""SELECT Source_Import_SK, Source_Name,
  {Q.PROC_ORDER} AS Processing_Order, Staging_Table, DW_Table_Name, {Q.MERGE_PROC} AS Merge_Proc_Name
FROM src WHERE {Q.flag_sql('Is_Active')} AND NOT {Q.flag_sql('Is_Deleted')}
  AND {Q.PROC_ORDER} >= 1.0""")
def q_active_sources(spark, sf):
    a = M.active_sources(_sources(spark, sf))
    return a.select("Source_Import_SK", "Source_Name", "Processing_Order", "Staging_Table",
                    "DW_Table_Name", M.merge_proc_name().alias("Merge_Proc_Name"))


@query("config_sources", Q.with_(Q.SOURCES, Q.CONFIG_SOURCES) + "SELECT Source_Name FROM cand")
def q_config_sources(spark, sf):
    return M.config_sources(_sources(spark, sf))


@query("changed_sources", Q.with_(Q.SOURCES, Q.CONFIG_SOURCES, Q.MAPPING_STG, Q.LAST_CHECKED,
                                  "chg AS (SELECT Source_Name, max(Inserted_Datetime) AS "
                                  "Max_Mapping_Change FROM stg GROUP BY 1)")
       + f"""SELECT c.Source_Name, {Q.flag_sql('s.Force_DDL_Generation')} AS Force,
  k.Last_Checked, g.Max_Mapping_Change,
  {Q.flag_sql('s.Force_DDL_Generation')} OR k.Last_Checked IS NULL
    OR COALESCE(g.Max_Mapping_Change > k.Last_Checked, FALSE) AS Needs_Generation
FROM cand c LEFT JOIN src s ON c.Source_Name = s.Source_Name
  LEFT JOIN chg g ON c.Source_Name = g.Source_Name
  LEFT JOIN chk k ON c.Source_Name = k.Source_Name""")
def q_changed_sources(spark, sf):
    """C-01 with A-01 for all sources at once."""
    src = _sources(spark, sf)
    return M.changed_sources(M.config_sources(src), src,
                             M.last_mapping_change(mapping_stage(spark, sf)),
                             S.last_checked(_lineitem(spark, sf)))


@query("known_columns", Q.with_(Q.MAPPING_STG) + "SELECT * FROM stg")
def q_known_columns(spark, sf):
    return mapping_stage(spark, sf)


def metadata_result(spark, sf) -> scd.MergeResult:
    stg = mapping_stage(spark, sf)
    return scd.scd2_merge(S.mapping_dim(_lineitem(spark, sf)), stg, S.MAPPING_SPEC, S.T1,
                          close_on_delete=True)


_MAPPING_TEXT = set(S.MAPPING_SPEC.columns)
_META_CTES = Q.with_(Q.MAPPING_STG, Q.MAPPING_DIM,
                     Q.merge_ctes(S.MAPPING_SPEC, _MAPPING_TEXT, close_on_delete=True))


@query("metadata_merge", _META_CTES + Q.merged_select(S.MAPPING_SPEC))
def q_metadata_merge(spark, sf):
    """M-04: mapping dimension merge; a soft delete also closes the version."""
    return metadata_result(spark, sf).rows


@query("mapping_last_change", _META_CTES + "SELECT Source_Name, max(COALESCE(Updated_Datetime, "
       "Inserted_Datetime)) AS Max_Mapping_Change FROM (" + Q.merged_select(S.MAPPING_SPEC)
       + ") m WHERE Is_Deleted = 0 GROUP BY 1")
def q_mapping_last_change(spark, sf):
    """A-02 + P-13 over the merged mapping dimension."""
    return M.last_mapping_change(metadata_result(spark, sf).rows, use_updated=True)


@query("mapping_source_keys", Q.with_(Q.SOURCES, Q.MAPPING_STG) + """SELECT m.Source_Name,
  m.Target_Column, COALESCE(s.Source_Import_SK, 0) AS Source_Import_SK
FROM stg m LEFT JOIN src s ON m.Source_Name = s.Source_Name""")
def q_mapping_source_keys(spark, sf):
    """J-05: mapping rows with their source key (0 when the source is unknown)."""
    m = M.with_source_keys(mapping_stage(spark, sf), _sources(spark, sf))
    return m.select("Source_Name", "Target_Column", "Source_Import_SK")


@query("map_columns", "SELECT " + ", ".join(f"{s} AS {t}" for s, t in
                                            S.CUSTOMER_SOURCE.source_columns.items())
       + " FROM customer")
def q_map_columns(spark, sf):
    """P-05: source columns renamed to targets by name, in mapping order."""
    return M.map_columns(S.read(spark, sf, "customer"), S.CUSTOMER_SOURCE)


# --- audit log, checkpoints, retention (K-07, P-16, O-01, C-03, X-07) -----------------


def audit_events(spark, sf):
    """``events`` as an append-only audit log: one row per status change of a run."""
    e = S.read(spark, sf, "events")
    return e.select(F.col("user_id").alias("Audit_Source_Import_SK"),
                    F.col("ts").alias("Event_Time"), F.col("event_type").alias("Process_Status"),
                    "event_id")


_AUDIT_SQL = """WITH e AS (
  SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events),
agg AS (SELECT user_id, min(ts) AS Start_Time, max(ts) AS End_Time, count(*) AS Event_Count
        FROM events GROUP BY user_id),
audit AS (
  SELECT a.user_id AS Audit_Source_Import_SK, e.event_type AS Process_Status, a.Start_Time,
         a.End_Time, a.Event_Count, date_sub('second', a.Start_Time, a.End_Time) AS Duration_Seconds
  FROM agg a JOIN e ON a.user_id = e.user_id AND e.rn = 1)
"""


@query("audit_latest", _AUDIT_SQL + "SELECT * FROM audit")
def q_audit_latest(spark, sf):
    return AU.audit_latest(audit_events(spark, sf), tie_col="event_id")


@query("audit_top20", _AUDIT_SQL + "SELECT * FROM audit ORDER BY Start_Time DESC, "
       "Audit_Source_Import_SK DESC LIMIT 20")
def q_audit_top20(spark, sf):
    """O-01: the monitoring query; the limit is the feature (top-k)."""
    return AU.audit_top(AU.audit_latest(audit_events(spark, sf), tie_col="event_id"), 20)


@query("checkpoint_latest", """SELECT user_id AS Source_Import_SK,
  max(ts) FILTER (WHERE event_type = 'purchase') AS Last_Successful_Load_Datetime,
  max(ts) FILTER (WHERE event_type = 'view') AS Last_Checked
FROM events GROUP BY user_id""")
def q_checkpoint_latest(spark, sf):
    """C-03: latest load and check per source from an append-only state table."""
    e = S.read(spark, sf, "events").withColumnRenamed("user_id", "Source_Import_SK")
    return AU.checkpoint_latest(e, "Source_Import_SK", "ts", "event_type",
                                {"purchase": "Last_Successful_Load_Datetime", "view": "Last_Checked"})


@query("retention_purge", f"SELECT * FROM events WHERE ts >= {Q.RUN} - INTERVAL 7 DAY")
def q_retention_purge(spark, sf):
    """X-07: log rows kept under the default 7-day retention at the run time."""
    return AU.retention_purge(S.read(spark, sf, "events"), "ts", S.T1, 7)


# --- bulk-load logs (F-06, P-11) -----------------------------------------------------------


_EDGE = TX.EDGE_WS_PATTERN


@query("bulk_log_rejects", f"""WITH d AS (
  SELECT doc_id, string_split(regexp_replace(text, '{_EDGE}', '', 'g'), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(range(1, len(lines) + 1)) AS Line_Number, unnest(lines) AS Line FROM d)
SELECT doc_id, Line_Number,
  'BCP_REJECTED: ' || substring(regexp_replace(Line, '{_EDGE}', '', 'g'), 1, 200) AS Rejected_Reason
FROM l
WHERE regexp_replace(Line, '{_EDGE}', '', 'g') <> ''
  AND NOT starts_with(Line, '@') AND NOT starts_with(Line, 'SQLState')""")
def q_bulk_log_rejects(spark, sf):
    """F-06 over whole document texts read as error logs."""
    return BL.log_rejects(S.read(spark, sf, "documents"), "text", ["doc_id"])


# --- rebuild and schema evolution (M-06, M-07, M-11, O-03) --------------------------------


REBUILD_SPEC = DimensionSpec(
    name="Customer", keys=("c_custkey",),
    type1=("c_name", "c_nationkey", "c_acctbal", "c_phone"), type2=("c_mktsegment",),
    types={"c_custkey": "BIGINT", "c_name": "VARCHAR(25)", "c_nationkey": "BIGINT",
           "c_acctbal": "FLOAT", "c_phone": "VARCHAR(15)", "c_mktsegment": "VARCHAR(10)"})
EVOLVE_COLUMNS = {"c_phone": "string", "c_priority": "int"}


@query("rebuild_dim", _DIM1_ONLY + f"""SELECT Customer_SK, c_custkey, c_name,
  CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, CAST(NULL AS VARCHAR) AS c_phone,
  c_mktsegment, Inserted_Datetime, Updated_Datetime, Is_Deleted, Row_Change_Reason,
  1 AS Row_Is_Current, {Q.RUN} AS Row_Effective_Datetime, {Q.NULL_TS} AS Row_Expiry_Datetime
FROM dim""")
def q_rebuild_dim(spark, sf):
    """M-06/M-11: Type 1 customer dimension rebuilt as Type 2 with a new column, SKs kept."""
    return EV.rebuild_dimension(S.customer_dim_scd1(S.read(spark, sf, "customer")), REBUILD_SPEC, S.T1)


@query("evolve_schema", _DIM1_ONLY + "SELECT *, CAST(NULL AS VARCHAR) AS c_phone, "
       "CAST(NULL AS INTEGER) AS c_priority FROM dim")
def q_evolve_schema(spark, sf):
    return EV.evolve_schema(S.customer_dim_scd1(S.read(spark, sf, "customer")), EVOLVE_COLUMNS)


@query("union_distinct", _DIM1_ONLY + "SELECT DISTINCT * FROM (SELECT * FROM stg UNION ALL "
       "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM dim) u")
def q_union_distinct(spark, sf):
    """O-03: two extracts of one source stacked, whole-row distinct."""
    stg, c = _customer(spark, sf)
    return EV.union_distinct([stg, S.customer_dim_scd1(c).select(*S.CUSTOMER_SCD1.columns)])


# --- facts (X-01..X-06) ---------------------------------------------------------------------


_ORDER_COLS = ("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")


def order_lookup(spark, sf):
    o = S.read(spark, sf, "orders").select(*_ORDER_COLS)
    dim = S.customer_dim_scd2(S.read(spark, sf, "customer"))
    keys = FX.current_keys(dim, ["c_custkey"], "Customer_SK", scd2=True)
    looked = FX.lookup_keys(o, keys, ["o_custkey"], ["c_custkey"], "Customer_SK")
    return FX.split_missing(looked, "Customer_SK", ["o_custkey"], "Customer")


_FACT_KEYS = Q.with_(Q.CUSTOMER_DIM2,
                     "k AS (SELECT c_custkey, Customer_SK FROM dim WHERE Row_Is_Current = 1)")


@query("fact_lookup", _FACT_KEYS + "SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, "
       "o.o_totalprice, k.Customer_SK FROM orders o JOIN k ON o.o_custkey = k.c_custkey")
def q_fact_lookup(spark, sf):
    """X-01: order facts with the current customer SK."""
    return order_lookup(spark, sf)[0]


@query("fact_missing_fk", _FACT_KEYS + "SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, "
       "o.o_totalprice, 'MISSING_FK: Customer o_custkey=' || CAST(o.o_custkey AS VARCHAR) "
       "AS Rejected_Reason FROM orders o WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.c_custkey = o.o_custkey)")
def q_fact_missing_fk(spark, sf):
    """X-01: order facts whose customer has no current dimension row, with the reason."""
    return order_lookup(spark, sf)[1]


_FACT_GROUP = "l_returnflag, l_linestatus, date_trunc('month', l_shipdate)"


@query("fact_aggregate", f"SELECT l_returnflag, l_linestatus, date_trunc('month', l_shipdate) "
       f"AS ship_month, {Q.FACT_SUMS} FROM lineitem GROUP BY {_FACT_GROUP}")
def q_fact_aggregate(spark, sf):
    """X-02: line fact summed at (return flag, status, ship month)."""
    li = S.with_ship_month(_lineitem(spark, sf))
    return FX.aggregate(li, S.FACT_GRAIN, S.FACT_MEASURES)


@query("fact_incremental", f"SELECT * FROM lineitem WHERE l_shipdate > {Q.tsql(S.FACT_HWM)}")
def q_fact_incremental(spark, sf):
    """X-03: lines above the stored high-water mark (filter pushed to the scan)."""
    return FX.incremental(_lineitem(spark, sf), "l_shipdate", S.FACT_HWM)


_FACT_MERGE_SQL = f"""WITH ex AS (
  SELECT l_returnflag, l_linestatus, date_trunc('month', l_shipdate) AS ship_month, {Q.FACT_SUMS},
         {Q.tsql(S.T0)} AS Inserted_Datetime, {Q.NULL_TS} AS Updated_Datetime
  FROM lineitem WHERE l_shipdate < {Q.tsql(S.FACT_OLD_BEFORE)} AND l_discount > 0
  GROUP BY {_FACT_GROUP}),
nw AS (SELECT l_returnflag, l_linestatus, date_trunc('month', l_shipdate) AS ship_month, {Q.FACT_SUMS}
       FROM lineitem GROUP BY {_FACT_GROUP}),
j AS (
  SELECT e.*, n.Sum_Quantity AS n_q, n.Sum_Extended_Price AS n_p, n.Row_Count AS n_c,
         n.l_returnflag IS NOT NULL AS hit
  FROM ex e LEFT JOIN nw n ON e.l_returnflag IS NOT DISTINCT FROM n.l_returnflag
    AND e.l_linestatus IS NOT DISTINCT FROM n.l_linestatus AND e.ship_month IS NOT DISTINCT FROM n.ship_month),
k AS (SELECT *, hit AND (Sum_Quantity IS DISTINCT FROM n_q OR Sum_Extended_Price IS DISTINCT FROM n_p
                         OR Row_Count IS DISTINCT FROM n_c) AS upd FROM j)
SELECT l_returnflag, l_linestatus, ship_month,
  CASE WHEN upd THEN n_q ELSE Sum_Quantity END AS Sum_Quantity,
  CASE WHEN upd THEN n_p ELSE Sum_Extended_Price END AS Sum_Extended_Price,
  CASE WHEN upd THEN n_c ELSE Row_Count END AS Row_Count,
  Inserted_Datetime, CASE WHEN upd THEN {Q.RUN} ELSE Updated_Datetime END AS Updated_Datetime,
  CASE WHEN upd THEN 'update' ELSE 'keep' END AS Action
FROM k
UNION ALL
SELECT n.l_returnflag, n.l_linestatus, n.ship_month, n.Sum_Quantity, n.Sum_Extended_Price, n.Row_Count,
  {Q.RUN}, {Q.NULL_TS}, 'insert'
FROM nw n WHERE NOT EXISTS (SELECT 1 FROM ex e WHERE e.l_returnflag IS NOT DISTINCT FROM n.l_returnflag
  AND e.l_linestatus IS NOT DISTINCT FROM n.l_linestatus AND e.ship_month IS NOT DISTINCT FROM n.ship_month)"""


@query("fact_merge", _FACT_MERGE_SQL)
def q_fact_merge(spark, sf):
    """X-05: monthly line fact merged by grain: late lines update, new months insert."""
    li = S.with_ship_month(_lineitem(spark, sf))
    old = li.filter((F.col("l_shipdate") < S.ts(S.FACT_OLD_BEFORE)) & (F.col("l_discount") > 0))
    existing = FX.aggregate(old, S.FACT_GRAIN, S.FACT_MEASURES).withColumns(
        {"Inserted_Datetime": S.ts(S.T0), "Updated_Datetime": S.null_ts()})
    incoming = FX.aggregate(li, S.FACT_GRAIN, S.FACT_MEASURES)
    return FX.fact_merge(existing, incoming, list(S.FACT_GRAIN),
                         [*S.FACT_MEASURES, "Row_Count"], S.T1)


@query("fact_invalid_measure", f"""SELECT * FROM (
  SELECT *, CASE WHEN {Q.LINE_REASON} IS NULL THEN NULL ELSE 'INVALID_MEASURE: ' || {Q.LINE_REASON} END
    AS Rejected_Reason FROM lineitem) r WHERE Rejected_Reason IS NOT NULL""")
def q_fact_invalid_measure(spark, sf):
    """X-06: lines breaking a measure rule, with every failed rule named."""
    return FX.split_invalid(_lineitem(spark, sf), S.line_rules())[1]


@query("fact_measure_totals", f"""SELECT {Q.FACT_SUMS} FROM lineitem
WHERE {Q.LINE_REASON} IS NULL""")
def q_fact_measure_totals(spark, sf):
    """X-06 audit: measure totals of the valid lines."""
    valid = FX.split_invalid(_lineitem(spark, sf), S.line_rules())[0]
    return FX.measure_totals(valid, S.FACT_MEASURES)


# --- flagship: load one source, then merge it (R-02 + M-01) ------------------------------


def customer_pipeline(spark, sf) -> tuple[PL.SourceLoad, scd.MergeResult]:
    text = SRC.scan_source(spark, sf, "customer.parquet", as_text=True, lineage=True)
    load = PL.load_source(text, S.CUSTOMER_PIPELINE, "Customer", 1, S.T1)
    staged = load.staging.select(*S.CUSTOMER_PIPELINE.columns)
    dim = S.customer_dim_scd1(S.read(spark, sf, "customer"))
    return load, scd.scd1_merge(dim, staged, S.CUSTOMER_PIPELINE, S.T1)


@query("pipeline_customer", Q.with_(
    "stg AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer)",
    Q.CUSTOMER_DIM1, Q.merge_ctes(S.CUSTOMER_SCD1, Q.CUSTOMER_TEXT)) + Q.merged_select(S.CUSTOMER_SCD1))
def q_pipeline_customer(spark, sf):
    """Flagship: scan customer as text with lineage, sanitize, de-duplicate, type, merge (SCD1)."""
    return customer_pipeline(spark, sf)[1].rows


def lineitem_load(spark, sf) -> PL.SourceLoad:
    text = SRC.scan_source(spark, sf, "lineitem.parquet", as_text=True, lineage=True)
    return PL.load_source(text, S.LINEITEM_PIPELINE, "LineItem", 1, S.T1)


@query("pipeline_rejects", Q.with_(_LI_FILE_ORDER) + """SELECT 'lineitem.parquet' AS File_Name, file_row AS Row_Number,
  'DUPLICATE_RECORD: PK l_orderkey=' || CAST(l_orderkey AS VARCHAR) || ', l_linenumber='
    || CAST(l_linenumber AS VARCHAR) AS Rejected_Reason FROM dups""")
def q_pipeline_rejects(spark, sf):
    """Reject rows of the staged line load: every member of a duplicate key."""
    return lineitem_load(spark, sf).rejects.select("File_Name", "Row_Number", "Rejected_Reason")


@query("fact_incremental_stream", f"SELECT * FROM lineitem WHERE l_shipdate > {Q.tsql(S.FACT_HWM)}")
def q_fact_incremental_stream(spark, sf):
    """X-03 as a file stream (availableNow + foreachBatch) into a table, read back."""
    import uuid
    from dimkiln.session import checkpoint_dir
    from dimkiln.streaming.incremental import incremental_stream, read_loaded
    path = f"{sf}/lineitem.parquet"
    schema = spark.read.parquet(path).schema
    target = f"{table_dir(spark)}/fact"
    incremental_stream(spark, sf, schema, "l_shipdate", S.FACT_HWM, target,
                       f"{checkpoint_dir(spark).rstrip('/')}/streams/{uuid.uuid4().hex}",
                       pattern="lineitem.parquet")
    return read_loaded(spark, target)


# --- orders Type 2 merge (the larger SCD2 bench case) ------------------------------------

_ORDERS_CTES = Q.with_(Q.ORDERS_STG, Q.ORDERS_DIM2, Q.merge_ctes(S.ORDERS_SCD2, Q.ORDERS_TEXT))


def orders_result(spark, sf) -> scd.MergeResult:
    o = S.read(spark, sf, "orders")
    return scd.scd2_merge(S.orders_dim_scd2(o), S.orders_staging(o), S.ORDERS_SCD2, S.T1)


@query("scd2_merge_orders", _ORDERS_CTES + Q.merged_select(S.ORDERS_SCD2))
def q_scd2_merge_orders(spark, sf):
    return orders_result(spark, sf).rows


@query("scd2_merge_orders_counts", _ORDERS_CTES + Q.COUNTS_SELECT)
def q_scd2_merge_orders_counts(spark, sf):
    return orders_result(spark, sf).counts()


_LI_STAGED = Q.with_("""numbered AS (SELECT *, row_number() OVER () + 1 AS file_row FROM lineitem),
first AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY file_row) AS rn
          FROM numbered) r WHERE rn = 1)""") + "SELECT " + ", ".join(
    f"{Q.typed_value_sql(f'CAST({c} AS VARCHAR)', S.LINEITEM_PIPELINE.types[c])} AS {c}"
    for c in S.LINEITEM_PIPELINE.columns) + f", file_row AS _row_number, {Q.RUN} AS Inserted_Datetime FROM first"


@query("pipeline_lineitem", _LI_STAGED)
def q_pipeline_lineitem(spark, sf):
    """R-02 on the largest table: text scan with lineage, clean-up, typed load and
    de-duplication; every staged row with its load timestamp (P-07)."""
    return lineitem_load(spark, sf).staging.drop(SRC.FILE_NAME, SRC.FILE_PATH)


# --- loads that write tables and read them back ------------------------------------------


@query("multi_file_source", """SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name,
  CAST(s_nationkey AS VARCHAR) AS s_nationkey FROM supplier""")
def q_multi_file_source(spark, sf):
    """S-04: supplier as CSV files of two column orders, read back by name."""
    s = S.read(spark, sf, "supplier")
    folder = f"{table_dir(spark)}/supplier"
    odd = F.col("s_suppkey") % 2 == 1
    for rows, columns in ((s.filter(odd), ["s_suppkey", "s_name", "s_nationkey"]),
                          (s.filter(~odd), ["s_nationkey", "s_suppkey", "s_name"])):
        rows.select(*columns).write.mode("append").option("header", True).csv(folder)
    return SRC.scan_source(spark, folder, "*.csv").select("s_suppkey", "s_name", "s_nationkey")


@query("typed_duplicate_keys", """WITH t AS (
  SELECT p_partkey, p_name, 1 AS member FROM part
  UNION ALL SELECT p_partkey, p_name || ' again', 2 FROM part WHERE p_partkey % 3 = 0)
SELECT 'staged' AS load_kind, p_partkey, p_name, CAST(NULL AS VARCHAR) AS Rejected_Reason FROM t
  WHERE member = 1
UNION ALL SELECT 'reject', p_partkey, p_name, 'DUPLICATE_RECORD: PK p_partkey='
  || CASE WHEN member = 2 THEN '00' ELSE '' END || CAST(p_partkey AS VARCHAR) FROM t WHERE p_partkey % 3 = 0""")
def q_typed_duplicate_keys(spark, sf):
    """M-09: keys that differ as text ('7', '007') but not as numbers are one staging key."""
    p = S.read(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("p_partkey"), "p_name")
    again = p.filter(F.col("p_partkey").cast("long") % 3 == 0).select(
        F.concat(F.lit("00"), "p_partkey").alias("p_partkey"), F.concat("p_name", F.lit(" again")).alias("p_name"))
    text = p.withColumn(SRC.ROW_NUMBER, F.lit(2).cast("long")).unionByName(
        again.withColumn(SRC.ROW_NUMBER, F.lit(3).cast("long")))
    spec = DimensionSpec("Part", keys=("p_partkey",), type1=("p_name",),
                         types={"p_partkey": "BIGINT", "p_name": "VARCHAR(100)"})
    load = PL.load_source(text, spec, "Part", 1, S.T1)
    staged = load.staging.select(F.lit("staged").alias("load_kind"), "p_partkey", "p_name",
                                 F.lit(None).cast("string").alias("Rejected_Reason"))
    raw = F.from_json("Raw_Data", "p_partkey string, p_name string")
    rejects = load.rejects.select(F.lit("reject").alias("load_kind"), raw["p_partkey"].cast("long").alias("p_partkey"),
                                  raw["p_name"].alias("p_name"), "Rejected_Reason")
    return staged.unionByName(rejects)


@query("fact_incremental_two_loads", "SELECT * FROM lineitem")
def q_fact_incremental_two_loads(spark, sf):
    """X-03: the lines up to a day, then all lines, each above the stored mark, in one table."""
    from dimkiln.streaming.incremental import load_increment, read_loaded
    li, root = _lineitem(spark, sf), table_dir(spark)
    early = li.filter(F.col("l_shipdate") <= S.ts(S.FACT_HWM))
    for rows in (early, li):
        load_increment(spark, rows, "l_shipdate", f"{root}/fact", f"{root}/state", "lineitem")
    return read_loaded(spark, f"{root}/fact")


@query("rebuild_demote", Q.with_(Q.CUSTOMER_DIM2) + """SELECT Customer_SK, c_custkey, c_name, c_nationkey,
  c_acctbal, c_mktsegment, Inserted_Datetime, Updated_Datetime, Is_Deleted, Row_Change_Reason
FROM dim WHERE Row_Is_Current = 1""")
def q_rebuild_demote(spark, sf):
    """M-06: a Type 2 dimension rebuilt as Type 1 keeps one version of each key."""
    return EV.split_rebuild(S.customer_dim_scd2(S.read(spark, sf, "customer")), S.CUSTOMER_SCD1, S.T1)[0]


def _customer_mapping(spark, type2: bool):
    from dimkiln.operators.metadata import MAPPING_COLUMNS
    kinds = {"c_custkey": "BIGINT", "c_name": "VARCHAR(100)", "c_mktsegment": "VARCHAR(20)"}
    rows = [{"Source_Name": "Customer", "Source_Column": c, "Target_Column": c, "Data_Type": t,
             "Is_Type2_Attribute": "1" if type2 and c == "c_mktsegment" else "0",
             "Is_PK": "1" if c == "c_custkey" else "0", "Is_Required": "0"} for c, t in kinds.items()]
    rows.append({"Source_Name": "Unmapped", "Source_Column": "x", "Target_Column": "x", "Data_Type": "INT"})
    return spark.createDataFrame([tuple(r.get(c) for c in MAPPING_COLUMNS) for r in rows],
                                 ", ".join(f"{c} string" for c in MAPPING_COLUMNS))


def _customer_imports(spark, *more):
    from dimkiln.operators.metadata import SOURCE_IMPORTS_COLUMNS
    rows = [{"Source_Name": n, "Rel_Path": "", "Pattern": "customer.parquet", "Processing_Order": "1.0",
             "Is_Active": "1"} for n in ("Customer", *more)]
    return spark.createDataFrame([tuple(r.get(c) for c in SOURCE_IMPORTS_COLUMNS) for r in rows],
                                 ", ".join(f"{c} string" for c in SOURCE_IMPORTS_COLUMNS))


@query("refresh_metadata_two_runs", f"""SELECT c_custkey * 2 AS Customer_SK, c_custkey, c_name, c_mktsegment,
  {Q.tsql(S.T0)} AS Inserted_Datetime, {Q.NULL_TS} AS Updated_Datetime, 0 AS Is_Deleted, 'NEW' AS Row_Change_Reason,
  1 AS Row_Is_Current, {Q.tsql("2024-03-01 00:00:00")} AS Row_Effective_Datetime, {Q.NULL_TS} AS Row_Expiry_Datetime,
  'Customer' AS first_run, 'Customer' AS second_run FROM customer""")
def q_refresh_metadata_two_runs(spark, sf):
    """R-03, C-01, C-02: a mapping row that becomes a Type 2 attribute regenerates its
    source; an active source without a mapped key is passed over."""
    layout = PL.Layout(table_dir(spark))
    c = S.read(spark, sf, "customer").select(
        (F.col("c_custkey") * 2).alias("Customer_SK"), "c_custkey", "c_name", "c_mktsegment",
        S.ts(S.T0).alias("Inserted_Datetime"), S.null_ts().alias("Updated_Datetime"), F.lit(0).alias("Is_Deleted"),
        F.lit("NEW").alias("Row_Change_Reason"))
    table = BucketTable(spark, layout.dimension("Customer"))
    table.write(c, ["c_custkey"])
    runs = []
    for n, (when, type2) in enumerate(((S.T1, False), ("2024-03-01 00:00:00", True)), 1):
        rep = PL.refresh_metadata(spark, layout, when, n, imports=_customer_imports(spark, "Unmapped"),
                                  mapping=_customer_mapping(spark, type2))
        runs.append(",".join(rep.sources))
    return table.read().withColumns({"first_run": F.lit(runs[0]), "second_run": F.lit(runs[1])})


@query("run_sources_audit", """SELECT s.n AS run, CASE WHEN s.n = 2 THEN 'Failed' ELSE 'Success' END AS Process_Status,
  CASE WHEN s.n = 2 THEN 0 ELSE c.rows END AS Total_Row_Count, CASE WHEN s.n = 2 THEN 0 ELSE 1 END AS Total_File_Count,
  CASE WHEN s.n = 1 THEN c.rows ELSE 0 END AS Inserted_Count, 0 AS Updated_Count,
  CASE WHEN s.n = 2 THEN 'requested sources not found: Custommer' END AS Exception_Detail
FROM (SELECT count(*) AS rows FROM customer) c, (VALUES (1), (2), (3)) s(n)""")
def q_run_sources_audit(spark, sf):
    """R-01, K-07, F-07: audit rows of a first load, a mistyped request and a second load."""
    from dimkiln.spec import spec_from_mapping, specs_rows
    layout = PL.Layout(table_dir(spark))
    sources = _customer_imports(spark).withColumns({"Source_Import_SK": F.lit(1).cast("long"),
                                                    "Is_Deleted": F.lit(0)})
    spec = spec_from_mapping("Customer", specs_rows(_customer_mapping(spark, False), ["Customer"])["Customer"])
    for n, requested in ((1, None), (2, ["Custommer"]), (3, ["Customer"])):
        PL.run_sources(spark, layout, sources, {"Customer": spec}, S.T1, sf, audit_id=n, requested=requested)
    ended = spark.read.parquet(layout.audit).filter(F.col("Process_Status") != "Running")
    return ended.select(F.col("Audit_Source_Import_SK").cast("int").alias("run"), "Process_Status",
                        "Total_Row_Count", "Total_File_Count", "Inserted_Count", "Updated_Count", "Exception_Detail")


@query("staging_truncate_load", "SELECT n_nationkey, n_name FROM nation")
def q_staging_truncate_load(spark, sf):
    """K-01: a second load replaces the first."""
    path = f"{table_dir(spark)}/ods"
    store.write_staging(S.read(spark, sf, "region").select(F.col("r_regionkey").alias("n_nationkey"),
                                                           F.col("r_name").alias("n_name")), path)
    store.write_staging(S.read(spark, sf, "nation").select("n_nationkey", "n_name"), path)
    return spark.read.parquet(path)


@query("staging_text_export", """SELECT CAST(c_custkey AS VARCHAR) || chr(9) || c_name || chr(9)
  || CASE WHEN c_nationkey % 5 = 0 THEN '' ELSE CAST(c_nationkey AS VARCHAR) END AS line FROM customer""")
def q_staging_text_export(spark, sf):
    """K-03: tab-separated lines with CRLF ends, NULL as empty, read back line by line."""
    path = f"{table_dir(spark)}/export"
    key = F.when(F.col("c_nationkey") % 5 != 0, F.col("c_nationkey"))
    store.export_staging_text(S.read(spark, sf, "customer").select("c_custkey", "c_name", key), path)
    return spark.read.option("lineSep", "\r\n").text(path).select(F.col("value").alias("line"))


@query("reject_csv_file", Q.with_(_LI_FILE_ORDER) + f"""SELECT '{S.T1}' AS Inserted_Datetime,
  'DUPLICATE_RECORD: PK l_orderkey=' || CAST(l_orderkey AS VARCHAR) || ', l_linenumber='
    || CAST(l_linenumber AS VARCHAR) AS Rejected_Reason, l_partkey AS raw_l_partkey FROM dups""")
def q_reject_csv_file(spark, sf):
    """K-05: the reject file of the line source, parsed again."""
    path = f"{table_dir(spark)}/rejected"
    store.write_reject_csv(lineitem_rejects(spark, sf), path, S.T1)
    back = spark.read.option("header", True).option("escape", '"').csv(path)
    return back.select("Inserted_Datetime", "Rejected_Reason",
                       F.get_json_object("Raw_Data", "$.l_partkey").cast("long").alias("raw_l_partkey"))


@query("snapshot_write_back", Q.with_(Q.CUSTOMER_STG, Q.CUSTOMER_DIM1, Q.merge_ctes(S.CUSTOMER_SCD1, Q.CUSTOMER_TEXT))
       + Q.merged_select(S.CUSTOMER_SCD1))
def q_snapshot_write_back(spark, sf):
    """K-06: a dimension written, merged into the next snapshot and read through its pointer."""
    stg, c = _customer(spark, sf)
    table = store.SnapshotTable(spark, f"{table_dir(spark)}/dim")
    table.write(S.customer_dim_scd1(c))
    res = scd.scd1_merge(table.read(), stg, S.CUSTOMER_SCD1, S.T1)
    store.write_with_counts(res.flagged, table, scd.merge_count_columns(),
                            validate=lambda rows: K.check_active_keys(rows, S.CUSTOMER_SCD1.keys, False))
    return table.read()


@query("log_purge", """SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= (
  SELECT max(o_orderdate) FROM orders) - INTERVAL 30 DAY""")
def q_log_purge(spark, sf):
    """X-07: a log in month folders, written in two loads and purged of what is older than 30
    days before its last day: expired months are dropped unread, one month is rewritten."""
    from dimkiln.sinks.daylog import DayLog
    orders = S.read(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    log = DayLog(spark, f"{table_dir(spark)}/log", "o_orderdate", monthly=True)
    for part in (F.col("o_orderkey") % 2 == 0, F.col("o_orderkey") % 2 != 0):
        log.append(orders.filter(part))
    log.purge(str(orders.agg(F.max("o_orderdate")).first()[0]), 30)
    log.compact(1)
    return log.read()


@query("processing_order", Q.with_(Q.SOURCES) + f"""SELECT Source_Name,
  row_number() OVER (ORDER BY {Q.PROC_ORDER}, Source_Name) AS place
FROM src WHERE {Q.flag_sql('Is_Active')} AND NOT {Q.flag_sql('Is_Deleted')} AND {Q.PROC_ORDER} >= 1.0""")
def q_processing_order(spark, sf):
    """O-02: the place of every active source in the run."""
    # numbered where the rows are, without a trip through the driver
    active = M.active_sources(_sources(spark, sf)).select("Source_Name", "Processing_Order")
    return K.assign_sk(active, ["Processing_Order", "Source_Name"], "place").select("Source_Name", "place")


import dimkiln.plans.catalog_storage  # noqa: E402,F401  (registers the storage queries)
