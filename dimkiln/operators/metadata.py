"""Source metadata operators (F-01, F-02, F-07, O-02, A-01, A-02, A-06, C-01, C-02,
J-05, P-05, P-06, S-07).

Metadata frames (``Source_Imports``, ``Source_File_Mapping``) are ordinary
DataFrames here: every rule is a filter, aggregate or join, evaluated for all
sources at once instead of one database round trip per source.
"""

from __future__ import annotations

from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimkiln.functions.flags import parse_flag
from dimkiln.functions.text import collapse_ws, key_renames, normalised_header, qualified, sk_name, strip_ws
from dimkiln.spec import IS_CURRENT, IS_DELETED, DimensionSpec

# Metadata sources that are not business data (F-02).
SYSTEM_SOURCES = ("Source_Imports", "Source_File_Mapping")
# Columns kept from the mapping sheet (P-06).
MAPPING_KNOWN_COLUMNS = ("Source_Name", "Source_Column", "Target_Column", "Data_Type",
                         "Description", "Is_Type2_Attribute", "Is_PK", "Is_Required",
                         "Inserted_Datetime")
# Fixed value: smallest processing order of a business source (F-01, coded as >= 1.0).
MIN_PROCESSING_ORDER = 1.0
# Columns of the two metadata sheets (load layouts of the metadata tables).
SOURCE_IMPORTS_COLUMNS = ("Source_Name", "Rel_Path", "Pattern", "Sheet_Name", "Staging_Table",
                          "Processing_Order", "Is_Active", "Description", "DW_Table_Name",
                          "Merge_Proc_Name", "Force_DDL_Generation")
MAPPING_COLUMNS = ("Source_Name", "Source_Column", "Target_Column", "Data_Type", "Description",
                   "Is_Type2_Attribute", "Is_PK", "Is_Required")
METADATA_SHEETS = ("Source_Imports", "Source_File_Mapping")

# The two metadata dimensions: sources (Type 1) and column mapping (Type 2,
# a soft delete also closes the version: M-04).
SOURCE_IMPORTS_SPEC = DimensionSpec(
    name="Source_Imports", keys=("Source_Name",),
    type1=tuple(c for c in SOURCE_IMPORTS_COLUMNS if c != "Source_Name"),
    sk_col="Source_Import_SK")
MAPPING_SPEC = DimensionSpec(
    name="Source_Imports_Mapping", keys=("Source_Name", "Target_Column"),
    type1=("Source_Column", "Description", "Is_PK", "Is_Type2_Attribute", "Is_Required"),
    type2=("Data_Type",), sk_col="File_Mapping_SK")


def processing_order(c: Column | str = "Processing_Order") -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.trim(col.cast("string")).try_cast("decimal(9,3)")


def _is_set(c: str) -> Column:
    return parse_flag(c)


def active_sources(sources: DataFrame, requested: Sequence[str] | None = None) -> DataFrame:
    """F-01 + F-07 + O-02: sources the orchestrator runs, in processing order.

    Active, not deleted and ``Processing_Order >= 1.0``; an explicit
    ``requested`` list replaces the rule (F-07). Ordered by order, then name
    (decision D-6).
    """
    if requested is not None:
        out = sources.filter(F.col("Source_Name").isin(list(requested)))
    else:
        out = sources.filter(_is_set("Is_Active") & ~_is_set("Is_Deleted")
                             & (processing_order() >= F.lit(MIN_PROCESSING_ORDER)))
    return out.withColumn("Processing_Order", processing_order()).orderBy(
        "Processing_Order", "Source_Name")


def config_sources(sources: DataFrame) -> DataFrame:
    """F-02 + A-06: distinct active data sources, system sources excluded."""
    return (sources.filter(_is_set("Is_Active") & ~F.col("Source_Name").isin(*SYSTEM_SOURCES))
            .select("Source_Name").distinct())


def merge_proc_name() -> Column:
    """S-07: the source's merge procedure, ``ETL.SP_Merge_Dim_<name>`` when blank."""
    default_proc = F.concat(F.lit("ETL.SP_Merge_Dim_"), F.col("Source_Name"))
    return F.when(F.trim(F.coalesce(F.col("Merge_Proc_Name"), F.lit(""))) == "", default_proc) \
        .otherwise(F.col("Merge_Proc_Name"))


def source_lookup(sources: DataFrame) -> DataFrame:
    """S-07: per source its tables and merge procedure (default by name) and SK (default 0)."""
    return sources.select("Source_Name", "Staging_Table", "DW_Table_Name",
                          merge_proc_name().alias("Merge_Proc_Name"),
                          F.coalesce(F.col("Source_Import_SK").cast("long"), F.lit(0).cast("long"))
                          .alias("Source_Import_SK"))


def trim_mapping(mapping: DataFrame) -> DataFrame:
    """P-03: text columns of the mapping sheet stripped and whitespace-collapsed."""
    return mapping.withColumns({f.name: collapse_ws(f.name) for f in mapping.schema.fields
                                if f.dataType.simpleString() == "string"})


def trim_imports(sources: DataFrame) -> DataFrame:
    """P-03: text columns of the imports sheet stripped."""
    return sources.withColumns({f.name: strip_ws(F.col(f.name)) for f in sources.schema.fields
                                if f.dataType.simpleString() == "string"})


def known_columns(mapping: DataFrame, known: Iterable[str] = MAPPING_KNOWN_COLUMNS) -> DataFrame:
    """P-06: keep the known columns (extras dropped), NULL text -> ''."""
    keep = [c for c in known if c in mapping.columns]
    out = mapping.select(*keep)
    text = [f.name for f in out.schema.fields if f.dataType.simpleString() == "string"]
    return out.na.fill("", subset=text)


def map_columns(df: DataFrame, spec: DimensionSpec) -> DataFrame:
    """P-04 + P-05: rename raw headers to targets by name, in mapping order.

    Key headers with spaces are first normalised (``Place code`` ->
    ``Place_code``). A mapped column missing from the data is an error
    (decision D-2), listing the missing names (O-04).
    """
    renamed = df.withColumnsRenamed(key_renames(df.columns, spec.source_columns.keys()))
    pairs = [(s if s in renamed.columns else s.replace(" ", "_").strip(), t)
             for s, t in spec.source_columns.items()]
    missing = [s for s, _ in pairs if s not in renamed.columns]
    if missing:
        raise ValueError(f"{spec.name}: columns missing from the source: {missing}")
    extra = [c for c in renamed.columns if c.startswith("_")]
    return renamed.select(*[F.col(s).alias(t) for s, t in pairs], *extra)


def missing_key_columns(columns: Iterable[str], keys: Iterable[str]) -> list[str]:
    """O-04: key columns absent from a frame's columns (driver-side set difference)."""
    have = set(columns)
    return [k for k in keys if k not in have]


def missing_keys(mapping: DataFrame, headers: DataFrame) -> DataFrame:
    """O-04 for all sources at once: (Source_Name, Missing): key columns no header of the source gives.

    ``headers`` is (Source_Name, Header). A header gives a key under its own name
    or, as key headers are renamed (P-04), with underscores for its spaces.
    """
    keys = mapping.filter(parse_flag("Is_PK")).select("Source_Name", F.col("Target_Column").alias("Missing")).distinct()
    names = headers.select("Source_Name", F.explode(F.array("Header", normalised_header("Header"))).alias("Missing"))
    return keys.join(names, ["Source_Name", "Missing"], "left_anti")


def column_order(mapping: DataFrame, order_col: str = "File_Mapping_SK") -> DataFrame:
    """W-03 for all sources at once: (Source_Name, Columns): live target columns in mapping order."""
    live = mapping.filter((F.col(IS_DELETED) == 0) & (F.col(IS_CURRENT) == 1) & F.col("Target_Column").isNotNull())
    listed = F.array_sort(F.collect_list(F.struct(order_col, "Target_Column")))
    return live.groupBy("Source_Name").agg(F.array_join(F.transform(listed, lambda c: c["Target_Column"]), ",").alias("Columns"))


def table_names(sources: DataFrame) -> DataFrame:
    """P-14, P-15 for all sources at once: staging and dimension names without brackets and the SK column."""
    return sources.select("Source_Name", qualified("Staging_Table").alias("Staging_Name"),
                          qualified("DW_Table_Name").alias("Dimension_Name"), sk_name("DW_Table_Name").alias("SK_Column"))


def last_mapping_change(mapping: DataFrame, use_updated: bool = False) -> DataFrame:
    """A-01 (``MAX(Inserted)``) or A-02 (``MAX(COALESCE(Updated, Inserted))``, not deleted).

    One aggregate for all sources instead of one query each.
    """
    if use_updated:
        ts = F.coalesce(F.col("Updated_Datetime"), F.col("Inserted_Datetime"))   # P-13
        mapping = mapping.filter(F.col("Is_Deleted") == 0)
    else:
        ts = F.col("Inserted_Datetime")
    return mapping.groupBy("Source_Name").agg(F.max(ts).alias("Max_Mapping_Change"))


def mapping_fingerprints(mapping: DataFrame) -> DataFrame:
    """C-01: (Source_Name, Fingerprint): a digest of each source's live mapping rows, in any order.

    The number of rows and the sum of their hashes: a partial aggregate, and a
    removed row changes it, which no change time of the rows left would show.
    """
    live = mapping.filter((F.col(IS_DELETED) == 0) & (F.col(IS_CURRENT) == 1))
    row = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in MAPPING_SPEC.columns]).cast("decimal(38,0)")
    return live.groupBy("Source_Name").agg(
        F.concat_ws(":", F.count(F.lit(1)).cast("string"), F.sum(row).cast("string")).alias("Fingerprint"))


def changed_sources(candidates: DataFrame, sources: DataFrame, mapping_changes: DataFrame,
                    last_checked: DataFrame, force_all: bool = False,
                    fingerprints: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """C-01/C-02: which sources need their structures regenerated.

    Forced (run flag or the source's ``Force_DDL_Generation``), never checked,
    or a mapping change newer than the last check, or, with ``fingerprints``
    (now, at the last check), other live mapping rows than at the last check.
    One predicate over joined frames for all sources; every input has one row
    per source.
    """
    force = F.lit(force_all) | F.coalesce(parse_flag("Force_DDL_Generation"), F.lit(False))
    j = (candidates.join(sources.select("Source_Name", "Force_DDL_Generation"), "Source_Name", "left")
         .join(mapping_changes, "Source_Name", "left")
         .join(last_checked, "Source_Name", "left"))
    newer = F.coalesce(F.col("Max_Mapping_Change") > F.col("Last_Checked"), F.lit(False))
    if fingerprints is not None:
        now, then = fingerprints
        j = (j.join(now.select("Source_Name", F.col("Fingerprint").alias("_now")), "Source_Name", "left")
             .join(then.select("Source_Name", F.col("Fingerprint").alias("_then")), "Source_Name", "left"))
        newer = newer | (F.col("_then").isNotNull() & ~F.col("_now").eqNullSafe(F.col("_then")))
    return j.select("Source_Name", force.alias("Force"), "Last_Checked", "Max_Mapping_Change",
                    (force | F.col("Last_Checked").isNull() | newer).alias("Needs_Generation"))


def with_source_keys(mapping: DataFrame, sources: DataFrame) -> DataFrame:
    """J-05: mapping rows with the key of their source (0 when unknown).

    A plain left join: Catalyst/AQE broadcast the sources side when its
    measured size is under the broadcast threshold, and shuffle otherwise.
    """
    keys = sources.select("Source_Name", F.col("Source_Import_SK").cast("long").alias("_sk"))
    return (mapping.join(keys, "Source_Name", "left")
            .withColumn("Source_Import_SK", F.coalesce(F.col("_sk"), F.lit(0).cast("long")))
            .drop("_sk"))


def read_metadata_workbook(spark, directory: str, pattern: str) -> tuple[DataFrame, DataFrame]:
    """S-03: the two metadata sheets of the workbook(s), every cell as text, fixed columns."""
    from dimkiln.sources.xlsx import read_xlsx
    imports = read_xlsx(spark, directory, pattern, METADATA_SHEETS[0], list(SOURCE_IMPORTS_COLUMNS))
    mapping = read_xlsx(spark, directory, pattern, METADATA_SHEETS[1], list(MAPPING_COLUMNS))

    return _fixed(imports, SOURCE_IMPORTS_COLUMNS), _fixed(mapping, MAPPING_COLUMNS)


def read_metadata_csv(spark, directory: str) -> tuple[DataFrame, DataFrame]:
    """S-03: the two metadata sheets as CSV files, each in the sub-folder of its sheet's name, every
    cell as text, fixed columns: others are dropped, missing ones NULL."""
    from dimkiln.sources.files import scan_source
    imports, mapping = (scan_source(spark, f"{directory.rstrip('/')}/{sheet}", "*.csv", lineage=False)
                        for sheet in METADATA_SHEETS)
    return _fixed(imports, SOURCE_IMPORTS_COLUMNS), _fixed(mapping, MAPPING_COLUMNS)


def _fixed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])


def spec_columns_from(mapping: DataFrame, name: str) -> Mapping[str, str]:
    """Source -> target names for one source (metadata, collected once)."""
    rows = (mapping.filter(F.col("Source_Name") == name)
            .select("Source_Column", "Target_Column").collect())
    return {r["Source_Column"]: r["Target_Column"] for r in rows}
