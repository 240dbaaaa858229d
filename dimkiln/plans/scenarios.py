"""Load scenarios derived from the given tables.

The test tables hold no staging/dimension pairs, so both sides are derived
deterministically from whole tables (survey §7.4). Key arithmetic only
decides which rows carry an injected change (a key left out of staging, an
older value in the dimension, a deleted flag, a historical version); every
row of the table takes part in each merge, so the work grows with the table.
The oracle SQL in ``plans.oracle`` derives the same frames in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimkiln.operators.metadata import MAPPING_SPEC
from dimkiln.spec import (EFFECTIVE, EXPIRY, INSERTED, IS_CURRENT, IS_DELETED, REASON,
                          UPDATED, DimensionSpec)

# Scenario timestamps (T0 = dimension built, T1 = this run).
T0 = "2024-01-01 00:00:00"
T1 = "2024-02-01 00:00:00"
T_HIST = "2023-01-01 00:00:00"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ts(value: str) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def null_ts() -> Column:
    return F.lit(None).cast("timestamp_ntz")


CUSTOMER_SCD1 = DimensionSpec(
    name="Customer", keys=("c_custkey",),
    type1=("c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
    required=("c_custkey", "c_name"))

CUSTOMER_SCD2 = DimensionSpec(
    name="Customer", keys=("c_custkey",),
    type1=("c_name", "c_nationkey", "c_acctbal"), type2=("c_mktsegment",),
    required=("c_custkey", "c_name"))



def customer_staging(customer: DataFrame) -> DataFrame:
    """Today's extract: every customer except keys divisible by 13 (gone)."""
    _K = F.col("c_custkey")
    return customer.filter(_K % 13 != 0).select(*CUSTOMER_SCD1.columns)


def _customer_base(customer: DataFrame) -> DataFrame:
    """Yesterday's state: keys divisible by 5 not loaded yet; divisible by 7
    an older balance; by 9 an older segment; by 11 soft-deleted."""
    _K = F.col("c_custkey")
    return customer.filter(_K % 5 != 0).select(
        (_K * 2 + 2).alias("Customer_SK"),
        _K.alias("c_custkey"), "c_name", "c_nationkey",
        F.when(_K % 7 == 0, F.col("c_acctbal") - 1).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        F.when(_K % 9 == 0, F.lit("OLD")).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
        ts(T0).alias(INSERTED), null_ts().alias(UPDATED),
        F.when(_K % 11 == 0, F.lit(1)).otherwise(F.lit(0)).alias(IS_DELETED),
        F.lit("NEW").alias(REASON))


def customer_dim_scd1(customer: DataFrame) -> DataFrame:
    return _customer_base(customer)


def customer_dim_scd2(customer: DataFrame) -> DataFrame:
    """As SCD1 plus the version columns; keys divisible by 4 also hold an
    expired historical version with segment ``H``."""
    base = _customer_base(customer)
    current = base.withColumns({IS_CURRENT: F.lit(1), EFFECTIVE: ts(T0), EXPIRY: null_ts()})
    hist = base.filter(F.col("c_custkey") % 4 == 0).withColumns({
        "Customer_SK": F.col("Customer_SK") - 1,
        "c_mktsegment": F.lit("H"),
        INSERTED: ts(T_HIST), UPDATED: ts(T0), IS_DELETED: F.lit(0),
        IS_CURRENT: F.lit(0), EFFECTIVE: ts(T_HIST), EXPIRY: ts(T0)})
    return current.unionByName(hist)


# --- lineitem: a staging load with duplicate keys ---------------------------

LINEITEM_KEYS = ("l_orderkey", "l_linenumber")
# File order stand-in: the views expose no row number, so "first" is defined
# by the remaining columns in this order (unique within each key group).
LINEITEM_ORDER = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
                  "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")

LINEITEM_SCD1 = DimensionSpec(
    name="LineItem", keys=LINEITEM_KEYS,
    type1=("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
           "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"))


def lineitem_staging(lineitem_dedup: DataFrame) -> DataFrame:
    """Composite-key staging: de-duplicated lines except orders divisible by 7."""
    return lineitem_dedup.filter(F.col("l_orderkey") % 7 != 0)


def lineitem_dim(lineitem_dedup: DataFrame) -> DataFrame:
    """Composite-key dimension: orders divisible by 3 not loaded yet; line 2
    holds an older quantity; orders divisible by 11 soft-deleted."""
    k = F.col("l_orderkey")
    return lineitem_dedup.filter(k % 3 != 0).select(
        (k * 8 + F.col("l_linenumber")).cast("long").alias("LineItem_SK"),
        *LINEITEM_KEYS,
        *[(F.when(F.col("l_linenumber") == 2, F.col(c) + 1).otherwise(F.col(c)) if c == "l_quantity"
           else F.col(c)).alias(c) for c in LINEITEM_SCD1.type1],
        ts(T0).alias(INSERTED), null_ts().alias(UPDATED),
        F.when(k % 11 == 0, F.lit(1)).otherwise(F.lit(0)).alias(IS_DELETED),
        F.lit("NEW").alias(REASON))


# --- part as a text source with damaged values (typed load) -----------------

PART_SPEC = DimensionSpec(
    name="Part", keys=("p_partkey",),
    type1=("p_name", "p_brand", "p_type", "p_size", "p_retailprice"),
    required=("p_partkey", "p_name"),
    types={"p_partkey": "BIGINT", "p_name": "VARCHAR(55)", "p_brand": "VARCHAR(10)",
           "p_type": "VARCHAR(25)", "p_size": "INT", "p_retailprice": "DECIMAL(12,2)"})


def part_raw_text(part: DataFrame) -> DataFrame:
    """Every part as a text row; keys divisible by 17 a bad size, 19 no name,
    23 a brand too long, 29 a bad price, 31 no key."""
    k = F.col("p_partkey")
    txt = lambda c: F.col(c).cast("string")
    return part.select(
        F.when(k % 31 == 0, F.lit(None).cast("string")).otherwise(txt("p_partkey")).alias("p_partkey"),
        F.when(k % 19 == 0, F.lit(None).cast("string")).otherwise(F.col("p_name")).alias("p_name"),
        F.when(k % 23 == 0, F.concat(F.col("p_brand"), F.lit("-EXTENDED")))
         .otherwise(F.col("p_brand")).alias("p_brand"),
        F.col("p_type"),
        F.when(k % 17 == 0, F.concat(txt("p_size"), F.lit("x"))).otherwise(txt("p_size")).alias("p_size"),
        F.when(k % 29 == 0, F.lit("n/a")).otherwise(txt("p_retailprice")).alias("p_retailprice"))


def event_flag_text(events: DataFrame) -> DataFrame:
    """Flag spellings as a spreadsheet holds them, one per event."""
    et, v = F.col("event_type"), F.col("value")
    text = (F.when(v < 5, F.lit("0")).when(et == "click", F.lit("1"))
            .when(et == "view", F.lit(" 1 ")).when(et == "purchase", F.lit("1.0"))
            .when(et == "signup", F.lit("True")).otherwise(F.lit("")))
    return events.select("event_id", text.alias("flag_text"))


# --- source metadata derived from supplier and lineitem ------------------------

SYSTEM_ROWS = (
    # Source_Import_SK, Source_Name, Processing_Order, Is_Active
    (-1, "Source_Imports", "1.0", "1"),
    (-2, "Source_File_Mapping", "1.0", "1"),
)


def sources_from_supplier(supplier: DataFrame) -> DataFrame:
    """``Source_Imports`` rows: one business source per supplier plus the two
    metadata sources. Nation 0 sorts below the 1.0 threshold, negative
    balances are inactive, nation 7 deleted, nation 3 forced, nation 5 has no
    merge procedure name."""
    spark = supplier.sparkSession
    nk, name = F.col("s_nationkey"), F.col("s_name")
    biz = supplier.select(
        (F.col("s_suppkey") + 1).cast("long").alias("Source_Import_SK"),
        name.alias("Source_Name"),
        F.concat(F.lit("raw/"), name).alias("Rel_Path"),
        F.lit("*.parquet").alias("Pattern"),
        F.lit(None).cast("string").alias("Sheet_Name"),
        F.concat(F.lit("[ODS].["), name, F.lit("]")).alias("Staging_Table"),
        F.concat(nk.cast("string"), F.lit(".5")).alias("Processing_Order"),
        F.when(F.col("s_acctbal") >= 0, F.lit("1")).otherwise(F.lit("0")).alias("Is_Active"),
        F.when(nk == 7, F.lit("1")).otherwise(F.lit("0")).alias("Is_Deleted"),
        F.concat(F.lit("[DW].[Dim_"), name, F.lit("]")).alias("DW_Table_Name"),
        F.when(nk == 5, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("[ETL].[SP_Merge_Dim_"), name, F.lit("]"))).alias("Merge_Proc_Name"),
        F.when(nk == 3, F.lit("1")).otherwise(F.lit("0")).alias("Force_DDL_Generation"))
    sys_rows = [(sk, n, f"config/{n}", "*.xlsx", n, f"[ETL].[{n}]", order, active, "0",
                 f"[ETL].[Dim_{n}]", None, "0") for sk, n, order, active in SYSTEM_ROWS]
    return biz.unionByName(spark.createDataFrame(sys_rows, biz.schema))


# Shipping-date windows of yesterday's and today's mapping sheet.
MAPPING_OLD_BEFORE = "1999-01-01 00:00:00"
MAPPING_NEW_FROM = "1997-01-01 00:00:00"
MAPPING_CHECK_FLAG = "R"


def mapping_snapshot(lineitem: DataFrame, lo: str | None, hi: str | None) -> DataFrame:
    """A mapping sheet: one row per (supplier source, line number) seen in
    the shipping window; the row's facts decide its attributes."""
    li = lineitem
    if lo is not None:
        li = li.filter(F.col("l_shipdate") >= ts(lo))
    if hi is not None:
        li = li.filter(F.col("l_shipdate") < ts(hi))
    g = li.groupBy("l_suppkey", "l_linenumber").agg(
        F.max("l_quantity").alias("_mq"), F.count(F.lit(1)).alias("_n"),
        F.max("l_shipdate").alias("_last"), F.min("l_discount").alias("_mind"))
    line = F.col("l_linenumber").cast("string")
    return g.select(
        F.concat(F.lit("Supplier#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0")).alias("Source_Name"),
        F.concat(F.lit("Line "), line).alias("Source_Column"),
        F.concat(F.lit("Line_"), line).alias("Target_Column"),
        F.when(F.col("_mq") >= 49, F.lit("DECIMAL(12,2)")).otherwise(F.lit("INT")).alias("Data_Type"),
        F.when(F.col("_n") == 1, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("lines "), F.col("_n").cast("string"))).alias("Description"),
        F.when(F.col("l_linenumber") == 1, F.lit("1")).otherwise(F.lit("0")).alias("Is_PK"),
        F.when(F.col("l_linenumber") == 7, F.lit("1")).otherwise(F.lit("0")).alias("Is_Type2_Attribute"),
        F.when(F.col("l_linenumber") <= 2, F.lit("1")).otherwise(F.lit("0")).alias("Is_Required"),
        F.col("_last").alias("Inserted_Datetime"),
        F.concat(F.lit("min discount "), F.col("_mind").cast("string")).alias("Extra_Column"),
        F.col("l_suppkey").alias("_suppkey"), F.col("l_linenumber").alias("_line"),
        F.col("_mind").alias("_min_discount"))


def mapping_staging(lineitem: DataFrame) -> DataFrame:
    return mapping_snapshot(lineitem, MAPPING_NEW_FROM, None)


def mapping_dim(lineitem: DataFrame) -> DataFrame:
    """Yesterday's mapping dimension; rows whose lines had a zero discount
    were soft-deleted."""
    snap = mapping_snapshot(lineitem, None, MAPPING_OLD_BEFORE)
    return snap.select(
        (F.col("_suppkey") * 8 + F.col("_line")).cast("long").alias("File_Mapping_SK"),
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in MAPPING_SPEC.columns],
        ts(T0).alias(INSERTED), null_ts().alias(UPDATED),
        F.when(F.col("_min_discount") == 0, F.lit(1)).otherwise(F.lit(0)).alias(IS_DELETED),
        F.lit("NEW").alias(REASON), F.lit(1).alias(IS_CURRENT), ts(T0).alias(EFFECTIVE),
        null_ts().alias(EXPIRY))


def last_checked(lineitem: DataFrame) -> DataFrame:
    """Per source the last structure check: the latest returned line."""
    return (lineitem.filter(F.col("l_returnflag") == MAPPING_CHECK_FLAG)
            .groupBy(F.concat(F.lit("Supplier#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0"))
                     .alias("Source_Name"))
            .agg(F.max("l_shipdate").alias("Last_Checked")))


# --- customer source mapping (P-05) --------------------------------------------

CUSTOMER_SOURCE = DimensionSpec(
    name="Customer", keys=("Customer_Code",),
    type1=("Customer_Name", "Nation_Key", "Account_Balance"), type2=("Market_Segment",),
    required=("Customer_Code", "Customer_Name"),
    types={"Customer_Code": "BIGINT", "Customer_Name": "VARCHAR(25)", "Nation_Key": "INT",
           "Account_Balance": "DECIMAL(12,2)", "Market_Segment": "VARCHAR(10)"},
    source_columns={"c_custkey": "Customer_Code", "c_name": "Customer_Name",
                    "c_nationkey": "Nation_Key", "c_acctbal": "Account_Balance",
                    "c_mktsegment": "Market_Segment"})

# The flagship pipeline keeps the table's own names and types.
CUSTOMER_PIPELINE = DimensionSpec(
    name="Customer", keys=("c_custkey",),
    type1=("c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
    required=("c_custkey", "c_name"),
    types={"c_custkey": "BIGINT", "c_name": "VARCHAR(25)", "c_nationkey": "INT",
           "c_acctbal": "FLOAT", "c_mktsegment": "VARCHAR(10)"})


# --- facts -------------------------------------------------------------------------

FACT_GRAIN = ("l_returnflag", "l_linestatus", "ship_month")
FACT_MEASURES = {"Sum_Quantity": "l_quantity", "Sum_Extended_Price": "l_extendedprice"}
FACT_HWM = "2001-06-30 00:00:00"
FACT_OLD_BEFORE = "2000-01-01 00:00:00"
# Measure rules of the line fact (discount policy maximum 8%).
MAX_DISCOUNT = 0.08
MAX_TAX = 0.08


def with_ship_month(lineitem: DataFrame) -> DataFrame:
    return lineitem.withColumn("ship_month", F.date_trunc("month", F.col("l_shipdate")))


def line_rules() -> dict[str, Column]:
    q, p, d, t = (F.col(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax"))
    return {"quantity_not_positive": q > 0, "price_not_positive": p > 0,
            "discount_out_of_range": (d >= 0) & (d <= MAX_DISCOUNT),
            "tax_out_of_range": (t >= 0) & (t <= MAX_TAX)}



ORDERS_SCD2 = DimensionSpec(
    name="Orders", keys=("o_orderkey",),
    type1=("o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"),
    type2=("o_orderstatus",))


def orders_staging(orders: DataFrame) -> DataFrame:
    """Today's extract: every order except keys divisible by 13."""
    return orders.filter(F.col("o_orderkey") % 13 != 0).select(*ORDERS_SCD2.columns)


def orders_dim_scd2(orders: DataFrame) -> DataFrame:
    """Yesterday's order dimension: keys divisible by 5 not loaded; by 7 an
    older price; by 9 an older status; by 11 deleted; by 4 an extra expired
    version."""
    k = F.col("o_orderkey")
    base = orders.filter(k % 5 != 0).select(
        (k * 2 + 2).alias("Orders_SK"), "o_orderkey", "o_custkey",
        F.when(k % 7 == 0, F.col("o_totalprice") - 1).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate", "o_orderpriority",
        F.when(k % 9 == 0, F.lit("X")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        ts(T0).alias(INSERTED), null_ts().alias(UPDATED),
        F.when(k % 11 == 0, F.lit(1)).otherwise(F.lit(0)).alias(IS_DELETED),
        F.lit("NEW").alias(REASON))
    current = base.withColumns({IS_CURRENT: F.lit(1), EFFECTIVE: ts(T0), EXPIRY: null_ts()})
    hist = base.filter(F.col("o_orderkey") % 4 == 0).withColumns({
        "Orders_SK": F.col("Orders_SK") - 1, "o_orderstatus": F.lit("H"),
        INSERTED: ts(T_HIST), UPDATED: ts(T0), IS_DELETED: F.lit(0),
        IS_CURRENT: F.lit(0), EFFECTIVE: ts(T_HIST), EXPIRY: ts(T0)})
    return current.unionByName(hist)


# The line source as a staged load: declared types of its columns.
LINEITEM_PIPELINE = DimensionSpec(
    name="LineItem", keys=LINEITEM_KEYS, type1=LINEITEM_SCD1.type1,
    required=("l_orderkey", "l_linenumber", "l_quantity"),
    types={"l_orderkey": "BIGINT", "l_linenumber": "INT", "l_partkey": "BIGINT",
           "l_suppkey": "BIGINT", "l_quantity": "DECIMAL(12,2)", "l_extendedprice": "DECIMAL(12,2)",
           "l_discount": "DECIMAL(4,2)", "l_tax": "DECIMAL(4,2)", "l_returnflag": "VARCHAR(1)",
           "l_linestatus": "VARCHAR(1)", "l_shipdate": "DATETIME"})


# --- files under names of their own ----------------------------------------------------

def put_file(rows: DataFrame, fmt: str, scratch: str, target: str, damage: bool = False) -> None:
    """``rows`` as one file at ``target``, on the store of the path; with ``damage`` its
    middle third is overwritten with zeros, so that it opens but does not read to the end.

    Spark writes the file under a name of its own; the store's streams copy it.
    """
    spark = rows.sparkSession
    writer = rows.coalesce(1).write.format(fmt)
    (writer.option("header", True) if fmt == "csv" else writer).save(scratch)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    made, to = jvm.org.apache.hadoop.fs.Path(scratch), jvm.org.apache.hadoop.fs.Path(target)
    fs = made.getFileSystem(conf)
    part = next(st for st in fs.listStatus(made) if st.getPath().getName().startswith("part-"))
    size = part.getLen()
    source, out = fs.open(part.getPath()), to.getFileSystem(conf).create(to)
    copy = jvm.org.apache.hadoop.io.IOUtils.copyBytes
    third = size // 3
    copy(source, out, third, False)
    if damage:
        for _ in range(third):
            out.write(0)
        source.skip(third)
    else:
        copy(source, out, third, False)
    copy(source, out, size - 2 * third, False)
    source.close()
    out.close()
