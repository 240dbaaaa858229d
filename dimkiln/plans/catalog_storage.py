"""Registered queries about files as users have them and about tables written in place."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimkiln.operators import evolve as EV
from dimkiln.operators import facts as FX
from dimkiln.operators import keys as K
from dimkiln.operators import metadata as M
from dimkiln.operators import scd
from dimkiln.plans import oracle as Q
from dimkiln.plans import pipeline as PL
from dimkiln.plans import scenarios as S
from dimkiln.plans.catalog import (_FACT_GROUP, _SCD2_CTES, _customer, _customer_imports, _customer_mapping, _lineitem,
                                   _sources, mapping_stage, query)
from dimkiln.session import table_dir
from dimkiln.sinks import store
from dimkiln.sinks.buckets import BucketTable, merge_result
from dimkiln.sources import files as SRC
from dimkiln.spec import spec_from_mapping, specs_rows

# --- tables that are written where they change ------------------------------------------


@query("snapshot_bucket_merge", _SCD2_CTES + Q.merged_select(S.CUSTOMER_SCD2))
def q_snapshot_bucket_merge(spark, sf):
    """K-06, M-08: a Type 2 dimension in buckets, merged where it changes."""
    stg, c = _customer(spark, sf)
    spec = S.CUSTOMER_SCD2
    table = BucketTable(spark, f"{table_dir(spark)}/dim")
    table.write(S.customer_dim_scd2(c), spec.keys)
    merge_result(table, scd.scd2_merge(table.read(), stg, spec, S.T1), scd.merge_count_columns(),
                 lambda rows: K.check_active_keys(rows, spec.keys, True))
    return table.read()


@query("rebuild_rekey", Q.with_(Q.CUSTOMER_DIM1) + """SELECT Customer_SK,
  CASE WHEN place > 1 THEN 'DUPLICATE_KEY: c_nationkey=' || CAST(c_nationkey AS VARCHAR) || ', c_mktsegment='
    || c_mktsegment || ' stays with SK ' || CAST(kept AS VARCHAR) END AS Rejected_Reason
FROM (SELECT *, CASE WHEN Is_Deleted = 0 THEN row_number() OVER w END AS place,
        first_value(Customer_SK) OVER w AS kept
      FROM dim WINDOW w AS (PARTITION BY c_nationkey, c_mktsegment, Is_Deleted
        ORDER BY COALESCE(Updated_Datetime, Inserted_Datetime) DESC, Customer_SK)) r""")
def q_rebuild_rekey(spark, sf):
    """M-06, M-08: customers rekeyed by nation and segment: one active row a key stays."""
    spec = replace(S.CUSTOMER_SCD1, keys=("c_nationkey", "c_mktsegment"), type1=("c_custkey", "c_name", "c_acctbal"))
    table = BucketTable(spark, f"{table_dir(spark)}/dim")
    kept, rejects = EV.split_rebuild(S.customer_dim_scd1(_customer(spark, sf)[1]), spec, S.T1)
    table.write(kept, spec.keys, lambda rows: K.check_active_keys(rows, spec.keys, False))
    return table.read().select("Customer_SK", F.lit(None).cast("string").alias("Rejected_Reason")).unionByName(
        rejects.select(F.get_json_object("Raw_Data", "$.Customer_SK").cast("long").alias("Customer_SK"),
                       "Rejected_Reason"))


@query("fact_states_increments", f"SELECT l_returnflag, l_linestatus, date_trunc('month', l_shipdate) "
       f"AS ship_month, {Q.FACT_SUMS} FROM lineitem GROUP BY {_FACT_GROUP}")
def q_fact_states_increments(spark, sf):
    """X-02, X-05: stored sums after three increments, the second with wrong quantities
    that the third takes back."""
    li = S.with_ship_month(_lineitem(spark, sf)).withColumn("sign", F.lit(1))
    wrong = li.withColumn("l_quantity", F.col("l_quantity") + 1)
    line = F.col("l_linenumber")
    third = li.filter(line != 1).unionByName(wrong.filter(line == 2).withColumn("sign", F.lit(-1)))
    grain, measures = list(S.FACT_GRAIN), S.FACT_MEASURES
    table = BucketTable(spark, f"{table_dir(spark)}/states", buckets=8)
    for rows in (li.filter(line == 1), wrong.filter(line == 2), third):
        arriving = FX.fact_states(rows, grain, measures, F.col("sign"))
        if table.read() is None:
            table.write(arriving, [FX.STATE_KEY])
        else:
            table.merge(FX.add_states(table.read(), arriving, grain, measures), FX.STATE_KEY)
    return FX.finished(table.read(), grain, measures)


@query("fact_incremental_boundary",
       "SELECT * REPLACE (CAST(date_trunc('day', l_shipdate) AS TIMESTAMP) AS l_shipdate) FROM lineitem")
def q_fact_incremental_boundary(spark, sf):
    """X-03: rows of the mark's own day that come with a later load are loaded once."""
    from dimkiln.streaming.incremental import load_increment, read_loaded
    li, root = _lineitem(spark, sf), table_dir(spark)
    day = F.date_trunc("day", F.col("l_shipdate")).cast("timestamp_ntz")
    mark = S.ts(S.FACT_HWM)
    li = li.select(*[c for c in li.columns if c != "l_shipdate"], day.alias("l_shipdate"))
    first = li.filter((F.col("l_shipdate") < mark) | ((F.col("l_shipdate") == mark) & (F.col("l_linenumber") == 1)))
    second = li.filter(F.col("l_shipdate") <= mark)
    for rows in (first, second, second, li):
        load_increment(spark, rows, "l_shipdate", f"{root}/fact", f"{root}/state", "lineitem")
    return read_loaded(spark, f"{root}/fact").select(*_lineitem(spark, sf).columns)


@query("changed_sources_removed_row", f"""SELECT c_custkey * 2 AS Customer_SK, c_custkey, c_name,
  {Q.tsql(S.T0)} AS Inserted_Datetime, {Q.NULL_TS} AS Updated_Datetime, 0 AS Is_Deleted, 'NEW' AS Row_Change_Reason,
  'Customer' AS first_run, '' AS second_run, 'Customer' AS third_run FROM customer""")
def q_changed_sources_removed_row(spark, sf):
    """C-01: a mapping row that is gone from the sheet regenerates its source; an equal sheet does not."""
    layout = PL.Layout(table_dir(spark))
    c = S.read(spark, sf, "customer").select(
        (F.col("c_custkey") * 2).alias("Customer_SK"), "c_custkey", "c_name", "c_mktsegment",
        S.ts(S.T0).alias("Inserted_Datetime"), S.null_ts().alias("Updated_Datetime"), F.lit(0).alias("Is_Deleted"),
        F.lit("NEW").alias("Row_Change_Reason"))
    table = BucketTable(spark, layout.dimension("Customer"))
    table.write(c, ["c_custkey"])
    mapping = _customer_mapping(spark, False)
    fewer = mapping.filter("Target_Column <> 'c_mktsegment'")
    runs = [",".join(PL.refresh_metadata(spark, layout, when, n, imports=_customer_imports(spark), mapping=sheet).sources)
            for n, (when, sheet) in enumerate(((S.T1, mapping), ("2024-03-01 00:00:00", mapping),
                                               ("2024-04-01 00:00:00", fewer)), 1)]
    return table.read().withColumns({f"{n}_run": F.lit(r) for n, r in zip(("first", "second", "third"), runs)})


# --- files as users have them ------------------------------------------------------------


def _put(rows: DataFrame, fmt: str, target: str, damage: bool = False) -> None:
    S.put_file(rows, fmt, f"{table_dir(rows.sparkSession)}/made", target, damage)


# One file name of each kind that a reader could take for a pattern or for an encoded name.
ODD_NAMES = ("plain", "with space", "50% [of] it", "a{b,c}+d")
_ODD = "CASE s_suppkey % 4 " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(ODD_NAMES)) + " END"


@query("odd_file_names", f"""SELECT f.fmt AS fmt, {_ODD} || '.' || f.fmt AS file_name, CAST(s_suppkey AS VARCHAR) AS s_suppkey,
  s_name FROM supplier, (VALUES ('csv'), ('json'), ('orc'), ('parquet')) f(fmt)""")
def q_odd_file_names(spark, sf):
    """S-01, S-04: supplier in files with blanks, percent signs, brackets and braces in their names."""
    s = S.read(spark, sf, "supplier").select("s_suppkey", "s_name")
    out = None
    for fmt in ("csv", "json", "orc", "parquet"):
        folder = f"{table_dir(spark)}/in [{fmt}]"
        for i, name in enumerate(ODD_NAMES):
            _put(s.filter(F.col("s_suppkey") % 4 == i), fmt, f"{folder}/{name}.{fmt}")
        rows = SRC.scan_source(spark, folder, f"*.{fmt}").select(
            F.lit(fmt).alias("fmt"), F.col(SRC.FILE_NAME).alias("file_name"), "s_suppkey", "s_name")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("row_lineage_csv", """SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name,
  'file ' || CAST(p_partkey % 3 AS VARCHAR) || '.csv' AS file_name,
  row_number() OVER (PARTITION BY p_partkey % 3 ORDER BY p_partkey) + 1 AS row_number FROM part""")
def q_row_lineage_csv(spark, sf):
    """S-05: sheet-style row numbers of CSV files with two header orders."""
    p = S.read(spark, sf, "part").select("p_partkey", "p_name")
    folder = f"{table_dir(spark)}/csv"
    for i in range(3):
        rows = p.filter(F.col("p_partkey") % 3 == i).repartition(1).sortWithinPartitions("p_partkey")
        _put(rows if i else rows.select("p_name", "p_partkey"), "csv", f"{folder}/file {i}.csv")
    return SRC.scan_source(spark, folder, "*.csv").select(
        "p_partkey", "p_name", F.col(SRC.FILE_NAME).alias("file_name"), F.col(SRC.ROW_NUMBER).alias("row_number"))


def _customer_run(spark: SparkSession):
    sources = _customer_imports(spark).withColumns({"Source_Import_SK": F.lit(1).cast("long"), "Is_Deleted": F.lit(0),
                                                    "Pattern": F.lit("*.parquet")})
    spec = spec_from_mapping("Customer", specs_rows(_customer_mapping(spark, False), ["Customer"])["Customer"])
    return sources, spec


@query("damaged_file_load", """SELECT 'loaded' AS kind, c_custkey, c_name, c_mktsegment, NULL AS file_name
FROM customer WHERE c_custkey % 3 <> 1
UNION ALL SELECT 'rejected', NULL, NULL, NULL, 'part 1.parquet'""")
def q_damaged_file_load(spark, sf):
    """R-05: of three files one is damaged inside its data: its rows are withdrawn, the others load."""
    c = S.read(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    root = table_dir(spark)
    for i in range(3):
        _put(c.filter(F.col("c_custkey") % 3 == i), "parquet", f"{root}/data/part {i}.parquet", damage=i == 1)
    sources, spec = _customer_run(spark)
    layout = PL.Layout(f"{root}/wh")
    PL.run_sources(spark, layout, sources, {"Customer": spec}, S.T1, f"{root}/data", audit_id=1)
    loaded = BucketTable(spark, layout.dimension("Customer")).read().select(
        F.lit("loaded").alias("kind"), "c_custkey", "c_name", "c_mktsegment", F.lit(None).cast("string").alias("file_name"))
    rejects = store.committed(spark.read.parquet(layout.rejects), spark.read.parquet(layout.runs))
    none = F.lit(None)
    return loaded.unionByName(rejects.filter(F.col("Rejected_Reason").startswith("PROCESSING_ERROR")).select(
        F.lit("rejected").alias("kind"), none.cast("long").alias("c_custkey"), none.cast("string").alias("c_name"),
        none.cast("string").alias("c_mktsegment"), F.col("File_Name").alias("file_name")))


@query("rerun_after_failure", """SELECT c_custkey, 2 AS run, 2 AS attempts_written FROM customer WHERE c_custkey % 5 = 0
UNION ALL SELECT c_custkey, 2, 2 FROM customer WHERE c_custkey % 5 = 0""")
def q_rerun_after_failure(spark, sf):
    """K-04, K-07: a run that stops after its rejects and is repeated leaves each reject once."""
    c = S.read(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    root = table_dir(spark)
    c.unionByName(c.filter("c_custkey % 5 = 0")).repartition("c_custkey").write.parquet(f"{root}/data")
    sources, spec = _customer_run(spark)
    layout = PL.Layout(f"{root}/wh")

    def stop(dim, stg, run_ts):
        raise RuntimeError("stopped after the rejects")

    for run, now in ((1, replace(spec, merge=stop)), (2, spec)):
        PL.run_sources(spark, layout, sources, {"Customer": now}, S.T1, f"{root}/data", audit_id=run)
    log = spark.read.parquet(layout.rejects)
    rejects = store.committed(log, spark.read.parquet(layout.runs))
    attempts = log.select(F.count_distinct(store.ATTEMPT).alias("n")).first()["n"]
    return rejects.select(F.get_json_object("Raw_Data", "$.c_custkey").cast("long").alias("c_custkey"),
                          F.col("Audit_Source_Import_SK").cast("int").alias("run"),
                          F.lit(attempts).cast("int").alias("attempts_written"))


@query("source_pattern_scan", """SELECT 'csv' AS pattern, CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name FROM supplier
  WHERE s_suppkey % 3 < 2
UNION ALL SELECT 'none', CAST(count(*) AS VARCHAR), NULL FROM supplier WHERE FALSE""")
def q_source_pattern_scan(spark, sf):
    """S-01: the files of a folder that match a pattern; a pattern without files gives no rows."""
    s = S.read(spark, sf, "supplier").select("s_suppkey", "s_name")
    folder = f"{table_dir(spark)}/in"
    for i, name in enumerate(("first.csv", "second.csv", "second.csv.bak")):
        _put(s.filter(F.col("s_suppkey") % 3 == i), "csv", f"{folder}/{name}")
    found = SRC.scan_source(spark, folder, "*.csv").select(F.lit("csv").alias("pattern"), "s_suppkey", "s_name")
    none = SRC.scan_source(spark, folder, "*.none")
    return found.unionByName(none.agg(F.lit("none").alias("pattern"), F.count(F.lit(1)).cast("string").alias("s_suppkey"),
                                      F.lit(None).cast("string").alias("s_name")))


@query("spaced_headers_load", "SELECT c_custkey AS cust_key, c_name AS cust_name FROM customer")
def q_spaced_headers_load(spark, sf):
    """P-04, P-05: a CSV source whose headers hold spaces, loaded by its mapping."""
    folder = f"{table_dir(spark)}/in"
    rows = S.read(spark, sf, "customer").select(F.col("c_custkey").alias("cust key"), F.col("c_name").alias("cust name"))
    rows.write.option("header", True).csv(folder)
    spec = replace(S.CUSTOMER_SCD1, keys=("cust_key",), type1=("cust_name",), required=("cust_key",),
                   types={"cust_key": "BIGINT", "cust_name": "VARCHAR(25)"},
                   source_columns={"cust_key": "cust_key", "cust name": "cust_name"})
    return PL.load_source(SRC.scan_source(spark, folder, "*.csv"), spec, "Customer", 1, S.T1).staging.select(
        "cust_key", "cust_name")


@query("failed_run_errors", """SELECT 'merge:Customer' AS Procedure_Name, 'RuntimeError' AS Error_Class,
  'RuntimeError: the merge was refused for ' || CAST(count(*) AS VARCHAR) || ' rows' AS Error_Summary,
  'Customer: RuntimeError: the merge was refused for ' || CAST(count(*) AS VARCHAR) || ' rows' AS Exception_Detail,
  'Failed' AS Process_Status FROM customer""")
def q_failed_run_errors(spark, sf):
    """K-09, P-17, R-04: the error fact and the audit row of a source that failed in its merge."""
    root = table_dir(spark)
    S.read(spark, sf, "customer").write.parquet(f"{root}/data")
    sources, spec = _customer_run(spark)

    def refuse(dim, stg, run_ts):
        raise RuntimeError(f"the merge was refused for {stg.count()} rows")

    layout = PL.Layout(f"{root}/wh")
    PL.run_sources(spark, layout, sources, {"Customer": replace(spec, merge=refuse)}, S.T1, f"{root}/data", audit_id=1)
    audit = spark.read.parquet(layout.audit).filter("Process_Status <> 'Running'")
    run = "Audit_Source_Import_SK"
    return spark.read.parquet(layout.errors).join(audit.select(run, "Exception_Detail", "Process_Status"), run).select(
        "Procedure_Name", "Error_Class", "Error_Summary", "Exception_Detail", "Process_Status")


@query("table_names", Q.with_(Q.SOURCES) + """SELECT Source_Name,
  CASE WHEN contains(Staging_Table, '.') THEN '' ELSE 'dbo.' END || replace(replace(Staging_Table, '[', ''), ']', '') AS Staging_Name,
  replace(replace(DW_Table_Name, '[', ''), ']', '') AS Dimension_Name,
  replace(split_part(replace(replace(DW_Table_Name, '[', ''), ']', ''), '.', 2), 'Dim_', '') || '_SK' AS SK_Column FROM src""")
def q_table_names(spark, sf):
    """P-14, P-15: names of staging and dimension tables and surrogate keys of all sources."""
    return M.table_names(_sources(spark, sf))


@query("mapping_column_order", Q.with_(Q.MAPPING_DIM) + """SELECT Source_Name,
  string_agg(Target_Column, ',' ORDER BY File_Mapping_SK) AS Columns FROM dim
WHERE Is_Deleted = 0 AND Row_Is_Current = 1 GROUP BY 1""")
def q_mapping_column_order(spark, sf):
    """W-03: the live columns of every source in mapping order."""
    return M.column_order(S.mapping_dim(_lineitem(spark, sf)))


@query("missing_key_columns", Q.with_(Q.MAPPING_STG) + """SELECT Source_Name, Target_Column AS Missing FROM stg
WHERE Is_PK = '1' AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_discount = 0 AND l.l_tax = 0
  AND 'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') = stg.Source_Name
  AND 'Line_' || CAST(l_linenumber AS VARCHAR) = stg.Target_Column)""")
def q_missing_key_columns(spark, sf):
    """O-04: key columns of today's sheet that no header of the source gives; headers are
    the line numbers of its lines without discount and tax."""
    headers = _lineitem(spark, sf).filter("l_discount = 0 AND l_tax = 0").select(
        F.concat(F.lit("Supplier#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0")).alias("Source_Name"),
        F.concat(F.lit("Line "), F.col("l_linenumber").cast("string")).alias("Header")).distinct()
    return M.missing_keys(mapping_stage(spark, sf), headers)


@query("fact_load_strategies", "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem")
def q_fact_load_strategies(spark, sf):
    """X-04: a fact truncated and loaded, appended to, and one partition of it replaced."""
    li = _lineitem(spark, sf).select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    path = f"{table_dir(spark)}/fact"
    flag = F.col("l_returnflag")
    store.load_fact(li, path, "truncate", ["l_returnflag"])
    store.load_fact(li.filter(flag == "A"), path, "truncate", ["l_returnflag"])
    store.load_fact(li.filter(flag != "A").withColumn("l_quantity", F.when(flag == "N", -1.0).otherwise(F.col("l_quantity"))),
                    path, "append", ["l_returnflag"])
    store.load_fact(li.filter(flag == "N"), path, "replace_partitions", ["l_returnflag"])
    return spark.read.parquet(path).select(*li.columns)


@query("metadata_sheets", Q.with_(Q.SOURCES, Q.mapping_snapshot_cte("m_new", S.MAPPING_NEW_FROM, None))
       + """SELECT 'mapping' AS sheet, Source_Name, Target_Column, Data_Type, Description, Is_PK FROM m_new
UNION ALL SELECT 'imports', Source_Name, Staging_Table, Processing_Order, NULL, NULL FROM src""")
def q_metadata_sheets(spark, sf):
    """S-03: both metadata sheets read with their fixed columns, an extra one dropped, a missing one NULL."""
    root = table_dir(spark)
    mapping = S.mapping_staging(_lineitem(spark, sf))
    mapping.select(*[c for c in mapping.columns if not c.startswith("_") and c != "Inserted_Datetime"]).write.option(
        "header", True).csv(f"{root}/{M.METADATA_SHEETS[1]}")
    _sources(spark, sf).drop("Description").write.option("header", True).csv(f"{root}/{M.METADATA_SHEETS[0]}")
    imports, sheet = M.read_metadata_csv(spark, root)
    none = F.lit(None).cast("string")
    return sheet.select(F.lit("mapping").alias("sheet"), "Source_Name", "Target_Column", "Data_Type", "Description",
                        "Is_PK").unionByName(
        imports.select(F.lit("imports").alias("sheet"), "Source_Name", F.col("Staging_Table").alias("Target_Column"),
                       F.col("Processing_Order").alias("Data_Type"), none.alias("Description"), none.alias("Is_PK")))
