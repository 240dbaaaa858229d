"""Pipelines (R-01..R-05): load sources, merge dimensions, record audit rows.

``load_source`` composes the row operators into one plan per source
(scan -> sanitize -> map -> type -> de-duplicate -> stamp). ``run_sources``
walks the active sources in processing order (a driver loop over metadata,
tens of items); each source is a handful of Spark jobs, one per sink. Only
metadata, counts and status reach the driver.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimkiln.functions.text import DUPLICATE_PREFIX, error_line, sanitize_frame
from dimkiln.operators import dedup as D
from dimkiln.operators import keys as K
from dimkiln.operators import metadata as M
from dimkiln.operators import scd
from dimkiln.operators import typed_load as TL
from dimkiln.operators.audit import FAILED, RUNNING, SKIPPED, SUCCESS, file_lineage
from dimkiln.session import write_shared
from dimkiln.sinks import store
from dimkiln.sinks.buckets import BucketTable, merge_result
from dimkiln.sources.files import (FILE_NAME, FILE_PATH, ROW_NUMBER, damaged_files, file_manifest, format_for,
                                   list_files, path_exists, resolve_pattern, scan_source, source_defaults,
                                   unreadable_rejects)
from dimkiln.spec import INSERTED, DimensionSpec, flag_value

REJECT_COLUMNS = ("Audit_Source_Import_SK", "Source_Name", "File_Name", "Row_Number",
                  "Rejected_Reason", "Raw_Data")


# The kinds a loaded row is written under.
STAGED, REJECTED = "staged", "rejected"
KIND = "load_kind"
DUP_REASON, TYPE_REASON = "_dup_reason", "_type_reason"


@dataclass
class SourceLoad:
    """One source as a single frame of marked rows, and views of it.

    ``marked`` has every row read: typed columns, load timestamp, file name,
    path and row number, the duplicate and type reasons, the raw text as JSON
    where there is a reason, and ``load_kind``.
    """

    source_name: str
    spec: DimensionSpec
    audit_id: int
    marked: DataFrame

    @property
    def staging(self) -> DataFrame:
        """Typed, de-duplicated rows stamped with ``Inserted_Datetime``."""
        return self.marked.filter(F.col(KIND) == STAGED).select(
            *self.spec.columns, *[c for c in self.marked.columns if c in (FILE_NAME, FILE_PATH, ROW_NUMBER)],
            INSERTED)

    @property
    def rejects(self) -> DataFrame:
        """Duplicates (all members, the kept one included) and rows that failed typing."""
        reason = F.coalesce(TYPE_REASON, DUP_REASON)
        lineage = set(self.marked.columns)
        return self.marked.filter(reason.isNotNull()).select(
            F.lit(self.audit_id).cast("long").alias("Audit_Source_Import_SK"),
            F.lit(self.source_name).alias("Source_Name"),
            (F.col(FILE_NAME) if FILE_NAME in lineage else F.lit(None).cast("string")).alias("File_Name"),
            (F.col(ROW_NUMBER).cast("long") if ROW_NUMBER in lineage else F.lit(None).cast("long"))
            .alias("Row_Number"),
            reason.alias("Rejected_Reason"), "Raw_Data")

    def stored(self, path: str) -> "SourceLoad":
        """The same load with ``marked`` written once under ``path``, split by kind."""
        store.write_staging(self.marked, path, partition_by=[KIND])
        frame = self.marked.sparkSession.read.schema(self.marked.schema).parquet(path)
        return SourceLoad(self.source_name, self.spec, self.audit_id, frame)


def load_source(text_df: DataFrame, spec: DimensionSpec, source_name: str, audit_id: int,
                run_ts: str, order_cols: Sequence[str] = (FILE_PATH, ROW_NUMBER)) -> SourceLoad:
    """R-02: one source from raw text rows to marked rows.

    Rows are cleaned, renamed and typed in one projection. Those that type
    are de-duplicated on their typed key (under the spec's collation), so
    ``'1'`` and ``'01'`` of a BIGINT key are one key in staging, as the key
    constraint of a staging table demands; the raw text stays in the reject
    row. The typed rows are written once to the shared folder; the duplicate
    keys come from their key and order columns alone and are joined to the
    rows, with at most one exchange of them, none when the duplicate keys are
    few enough to broadcast.
    """
    data_cols = [c for c in text_df.columns if not c.startswith("_")]
    df = sanitize_frame(text_df, data_cols)                                   # P-01, P-02
    if spec.source_columns:
        df = M.map_columns(df, spec)                                           # P-04, P-05
    missing = M.missing_key_columns(df.columns, spec.keys)                     # O-04
    if missing:
        raise ValueError(f"{source_name}: key columns missing after rename: {missing}")
    raw_cols = [c for c in df.columns if not c.startswith("_")]
    lineage = [c for c in (FILE_NAME, FILE_PATH, ROW_NUMBER) if c in df.columns]
    # every value is converted once: the key counts and the rows both read what is written here
    checked = write_shared(TL.check_rows(df, spec), "checked")                 # K-02, P-08
    order = [c for c in order_cols if c in lineage] or [c for c in spec.columns if c not in spec.keys]
    typed = F.col(TL.REASONS).isNull()
    found = D.duplicate_keys(checked, spec.keys, order, spec.collation, valid=typed)   # M-09, A-07
    marked = D.join_duplicate_keys(checked, found, spec.keys, order, "left", spec.collation)   # W-01, W-02
    raw_keys = F.concat_ws(", ", *[F.concat(F.lit(f"{k}="), F.coalesce(F.col(f"_raw_{k}"), F.lit("NULL")))
                                   for k in spec.keys])
    dup = F.when(typed & (F.col(D.DUP_COUNT) > 1), F.concat(F.lit(DUPLICATE_PREFIX), raw_keys))   # P-10
    bad = F.coalesce(TL.REASONS, dup).isNotNull()
    # P-09: the raw text as JSON, built after the join and for rejected rows only
    raw = F.to_json(F.struct(*[F.col(f"_raw_{c}" if c in spec.columns else c).alias(c) for c in raw_cols]),
                    {"ignoreNullFields": "false"})
    out = marked.select(
        *spec.columns, *lineage, F.lit(run_ts).cast("timestamp_ntz").alias(INSERTED),   # P-07
        dup.alias(DUP_REASON), F.col(TL.REASONS).alias(TYPE_REASON),
        F.when(bad, raw).alias("Raw_Data"),
        F.when(typed & F.col(D.WAS_KEPT), F.lit(STAGED)).otherwise(F.lit(REJECTED)).alias(KIND))
    return SourceLoad(source_name, spec, audit_id, out)


@dataclass
class Layout:
    """Where a run keeps its tables (all under one shared root)."""

    root: str

    def load(self, source: str) -> str:
        """All marked rows of the source's last load, split by kind."""
        return f"{self.root}/ods/{source}"

    def staging(self, source: str) -> str:
        return f"{self.load(source)}/{KIND}={STAGED}"

    def dimension(self, source: str) -> str:
        return f"{self.root}/dw/Dim_{source}"

    @property
    def rejects(self) -> str:
        return f"{self.root}/etl/Fact_Rejected_Rows"

    @property
    def audit(self) -> str:
        return f"{self.root}/etl/Fact_Audit_Source_Imports"

    @property
    def lineage(self) -> str:
        return f"{self.root}/etl/Fact_Source_File_Archive"

    @property
    def errors(self) -> str:
        return f"{self.root}/etl/Fact_ETL_Errors"

    @property
    def state(self) -> str:
        return f"{self.root}/etl/Source_Import_State"

    @property
    def runs(self) -> str:
        """Manifest of the loads whose log rows count (``store.committed``)."""
        return f"{self.root}/etl/Committed_Loads"

    @property
    def fingerprints(self) -> str:
        """Mapping fingerprints of sources at their checks."""
        return f"{self.root}/etl/Mapping_Fingerprints"

    def reject_csv(self, source: str) -> str:
        return f"{self.root}/rejected/{source}_rejected"


def audit_event(spark: SparkSession, audit_id: int, source_sk: int, status: str,
                start: dt.datetime, end: dt.datetime | None = None, rows: int = 0, files: int = 0,
                detail: str | None = None, pattern: str | None = None,
                counts: dict | None = None) -> DataFrame:
    """K-07/R-04: one audit event row (append-only; readers take the latest per run)."""
    c = counts or {}
    row = (int(audit_id), int(source_sk), start, end, int(rows), int(files), detail, pattern, status,
           dt.datetime.now(), *(int(c.get(k, 0)) for k in scd.COUNT_COLUMNS))
    schema = ("Audit_Source_Import_SK long, Source_Import_SK long, Start_Time timestamp_ntz, "
              "End_Time timestamp_ntz, Total_Row_Count long, Total_File_Count long, "
              "Exception_Detail string, Pattern string, Process_Status string, "
              "Event_Time timestamp_ntz, " + ", ".join(f"{k} long" for k in scd.COUNT_COLUMNS))
    return spark.createDataFrame([row], schema).withColumn("Source_Name", F.lit(str(source_sk)))


def next_audit_id(spark: SparkSession, layout: Layout) -> int:
    """K-07: the key of a new run: one above the largest key in the audit log.

    One scalar aggregate over the append-only log (single writer assumed).
    """
    if not path_exists(spark, layout.audit):
        return 1
    row = spark.read.parquet(layout.audit).agg(F.max("Audit_Source_Import_SK").alias("m")).first()
    return int(row["m"] or 0) + 1


@dataclass
class RunReport:
    status: str
    sources: list = field(default_factory=list)
    counts: dict = field(default_factory=dict)
    rows: int = 0
    files: int = 0
    error: str | None = None


def run_source(spark: SparkSession, layout: Layout, source: dict, spec: DimensionSpec,
               audit_id: int, run_ts: str, data_root: str) -> dict:
    """R-02 + merge + checkpoint for one source row; returns counts."""
    name = source["Source_Name"]
    pattern, sheet = source_defaults(source.get("Pattern"), source.get("Sheet_Name"))
    rel = (source.get("Rel_Path") or "").strip().lstrip("/\\")
    headers = list(spec.source_columns) or None
    folder = f"{data_root.rstrip('/')}/{rel}"
    pattern = resolve_pattern(spark, folder, pattern)                            # S-01
    if pattern is None:
        return {"rows": 0, "files": 0}
    attempt = store.new_attempt()

    def reject_files(errors: DataFrame) -> DataFrame:
        return unreadable_rejects(errors, name).select(
            F.lit(audit_id).cast("long").alias("Audit_Source_Import_SK"), "Source_Name", "File_Name",
            "Row_Number", "Rejected_Reason", F.to_json(F.struct("File_Name")).alias("Raw_Data"))

    manifest = file_manifest(spark, folder, pattern, sheet=sheet)                # R-05
    errors = manifest.filter(F.col("Error").isNotNull()).select("File_Name", "Error")
    bad_names = [r["File_Name"] for r in errors.select("File_Name").collect()]
    while True:
        bad = reject_files(errors)
        if bad_names and manifest.filter(~F.col("File_Name").isin(bad_names)).isEmpty():
            store.append_attempt(bad, layout.rejects, attempt)
            store.write_reject_csv(bad, layout.reject_csv(name), run_ts)
            raise ValueError(f"{name}: none of the {len(bad_names)} files found could be read")
        fmt = format_for(pattern)
        # pages that do not match their checksums are damage too, not values
        passing = ({"ignoreCorruptFiles": True, "parquet.page.verify-checksum.enabled": True}
                   if fmt in ("parquet", "orc") else {})
        text = scan_source(spark, folder, pattern, sheet=sheet, columns=headers, exclude=bad_names, options=passing)
        load = load_source(text, spec, name, audit_id, run_ts).stored(layout.load(name))   # K-01
        lineage = write_shared(file_lineage(load.marked, audit_id, int(source.get("Source_Import_SK") or 0)), "lineage")
        if fmt not in ("parquet", "orc"):
            break
        # a file damaged inside its data: withdraw all its rows, so load again without it
        damaged = damaged_files(manifest.filter(~F.col("File_Name").isin(bad_names)), lineage.select(
            F.col("Original_File_Name").alias("File_Name"), F.col("File_Row_Count").alias("Loaded")), fmt)
        found = [r["File_Name"] for r in damaged.select("File_Name").collect()]
        if not found:
            break
        errors, bad_names = errors.unionByName(damaged), bad_names + found
    rejects = load.rejects
    store.append_attempt(rejects.unionByName(bad), layout.rejects, attempt)     # K-04
    store.write_reject_csv(rejects.unionByName(bad), layout.reject_csv(name), run_ts)   # K-05
    store.append_attempt(lineage.withColumn("Source_Name", F.lit(name)), layout.lineage, attempt)  # K-08
    stats = lineage.agg(F.sum("File_Row_Count").alias("rows"), F.count(F.lit(1)).alias("files")).first()

    table = BucketTable(spark, layout.dimension(name))
    counts = merge_dimension(spark, table, load.staging.select(*spec.columns), spec, run_ts)   # M-01 / M-02
    state = spark.createDataFrame([(name, "load", dt.datetime.fromisoformat(run_ts))],
                                  "Source_Name string, Kind string, Checkpoint_Time timestamp_ntz")
    store.append(state, layout.state)                                            # C-03
    store.commit_attempt(spark, layout.runs, name, audit_id, attempt)
    return {"rows": int(stats["rows"] or 0), "files": int(stats["files"] or 0), **counts}


def run_sources(spark: SparkSession, layout: Layout, sources: DataFrame,
                specs: dict[str, DimensionSpec], run_ts: str, data_root: str,
                audit_id: int | None = None,
                requested: Sequence[str] | None = None,
                on_source: Callable[[str], None] | None = None) -> RunReport:
    """R-01: run active sources in order; stop at the first failure.

    Audit events: Running at start, Success or Failed (with one readable line
    of the error, P-17) at the end, with the rows, files and merge actions of
    the sources that loaded; a failure also appends an error fact (K-09). The
    final status reflects the failure (decision D-9). A requested name that
    no source has fails the run before any source is loaded (F-07).
    """
    start = dt.datetime.now()
    if audit_id is None:
        audit_id = next_audit_id(spark, layout)
    store.append(audit_event(spark, audit_id, 0, RUNNING, start, pattern="Full ETL Run"), layout.audit)
    active = [r.asDict() for r in M.active_sources(sources, requested).collect()]   # F-01, O-02
    report = RunReport(SUCCESS)
    totals = dict.fromkeys(scd.COUNT_COLUMNS, 0)
    unknown = sorted(set(requested or ()) - {r["Source_Name"] for r in active})
    if unknown:
        report.status, report.error = FAILED, f"requested sources not found: {', '.join(unknown)}"
        active = []
    for src in active:
        name = src["Source_Name"]
        if on_source:
            on_source(name)
        try:
            if name not in specs:
                raise ValueError(f"no mapping for source {name}")
            out = run_source(spark, layout, src, specs[name], audit_id, run_ts, data_root)
            report.rows += out.get("rows", 0)
            report.files += out.get("files", 0)
            report.counts[name] = out
            report.sources.append(name)
            for k in totals:
                totals[k] += out.get(k, 0)
        except Exception as exc:  # recorded, then the run stops (R-01)
            report.status, report.error = FAILED, f"{name}: {error_line(exc)}"
            store.append(store.error_row(spark, f"merge:{name}", exc, name, audit_id), layout.errors)
            break
    store.append(audit_event(spark, audit_id, 0, report.status, start, dt.datetime.now(),
                             report.rows, report.files, report.error, "Full ETL Run", totals), layout.audit)
    return report


def merge_dimension(spark: SparkSession, table: BucketTable, staged: DataFrame, spec: DimensionSpec,
                    run_ts: str, **kw) -> dict:
    """Merge ``staged`` into a bucketed dimension (created empty on first use).

    Only buckets with a changed or new row are written; the natural keys of these
    rows must have at most one active row each (M-08).
    """
    from dimkiln.operators.evolve import rebuild_dimension
    if table.read() is None:
        empty = staged.limit(0).withColumn(spec.sk, F.lit(None).cast("long"))
        table.write(rebuild_dimension(empty, spec, run_ts), spec.keys)
    res = scd.merge(table.read(), staged, spec, run_ts, **kw)
    return merge_result(table, res, scd.merge_count_columns(),
                        lambda rows: K.check_active_keys(rows, spec.keys, spec.is_scd2))


def _merge_into(spark: SparkSession, table: store.SnapshotTable, staged: DataFrame,
                spec: DimensionSpec, run_ts: str, **kw) -> dict:
    """Merge ``staged`` into the snapshot table (created empty on first use).

    The new snapshot becomes the current one only if each natural key has at
    most one active row in it (M-08).
    """
    from dimkiln.operators.evolve import rebuild_dimension
    dim = table.read()
    if dim is None:
        empty = staged.limit(0).withColumn(spec.sk, F.lit(None).cast("long"))
        dim = rebuild_dimension(empty, spec, run_ts)
    res = scd.merge(dim, staged, spec, run_ts, **kw)
    return store.write_with_counts(
        res.flagged, table, scd.merge_count_columns(),
        validate=lambda rows: K.check_active_keys(rows, spec.keys, spec.is_scd2))[1]


def refresh_metadata(spark: SparkSession, layout: Layout, run_ts: str, audit_id: int,
                     workbook_dir: str | None = None, pattern: str = "*.xlsx",
                     imports: DataFrame | None = None, mapping: DataFrame | None = None,
                     force_ddl: bool = False) -> RunReport:
    """R-03: metadata sheets -> staging -> metadata merges -> change detection -> rebuilds.

    The two sheets come from the workbook(s) matching ``pattern`` under
    ``workbook_dir`` (S-03) or as frames. No workbook: status Skipped (R-04).
    Sources whose mapping changed since their last check (C-01), or forced,
    get their dimension rebuilt in the layout of the new mapping (M-06, SKs
    kept; rows with a value that no longer fits go to the rejects) and a new
    last-check row (C-03). A source without a mapped key has nothing to build
    from and is passed over (C-02).
    """
    from dimkiln.operators.audit import checkpoint_latest
    from dimkiln.operators.evolve import split_rebuild
    from dimkiln.spec import spec_from_mapping, specs_rows
    start = dt.datetime.now()
    if imports is None or mapping is None:
        if not workbook_dir or not list_files(spark, workbook_dir, pattern):
            store.append(audit_event(spark, audit_id, 0, SKIPPED, start, dt.datetime.now(),
                                     detail="Config spreadsheet not found"), layout.audit)
            return RunReport(SKIPPED)
        imports, mapping = M.read_metadata_workbook(spark, workbook_dir, pattern)
    try:
        stamp = F.lit(run_ts).cast("timestamp_ntz")
        imports_stg = M.trim_imports(imports).withColumn(INSERTED, stamp)             # P-03, P-07
        mapping_stg = M.known_columns(M.trim_mapping(mapping)).withColumn(INSERTED, stamp)  # P-06
        store.write_staging(imports_stg, f"{layout.root}/etl/Source_Imports")          # K-01
        store.write_staging(mapping_stg, f"{layout.root}/etl/Source_File_Mapping")
        src_table = store.SnapshotTable(spark, f"{layout.root}/etl/Dim_Source_Imports")
        map_table = store.SnapshotTable(spark, f"{layout.root}/etl/Dim_Source_Imports_Mapping")
        staged_src = spark.read.parquet(f"{layout.root}/etl/Source_Imports").drop(INSERTED)
        staged_map = spark.read.parquet(f"{layout.root}/etl/Source_File_Mapping").drop(INSERTED)
        counts = {"Source_Imports": _merge_into(spark, src_table, staged_src.select(
                      *M.SOURCE_IMPORTS_SPEC.columns), M.SOURCE_IMPORTS_SPEC, run_ts),
                  "Source_File_Mapping": _merge_into(spark, map_table, staged_map.select(
                      *M.MAPPING_SPEC.columns), M.MAPPING_SPEC, run_ts, close_on_delete=True)}

        # C-01: one predicate for all sources; only the names of changed sources come back
        sources, mapping_dim = src_table.read(), map_table.read()
        if path_exists(spark, layout.state):
            checked = checkpoint_latest(spark.read.parquet(layout.state), "Source_Name",
                                        "Checkpoint_Time", "Kind", {"check": "Last_Checked"})
        else:
            checked = spark.createDataFrame([], "Source_Name string, Last_Checked timestamp_ntz")
        prints = M.mapping_fingerprints(mapping_dim)
        if path_exists(spark, layout.fingerprints):
            stored = (spark.read.parquet(layout.fingerprints).groupBy("Source_Name")
                      .agg(F.max_by("Fingerprint", "Checked_At").alias("Fingerprint")))
        else:
            stored = spark.createDataFrame([], "Source_Name string, Fingerprint string")
        # a role change updates a mapping row in place, so updates count as changes (A-02);
        # a removed row shows in the fingerprint only
        changed = M.changed_sources(M.config_sources(sources), sources,
                                    M.last_mapping_change(mapping_dim, use_updated=True), checked, force_ddl,
                                    (prints, stored))
        needed = [r["Source_Name"] for r in changed.filter("Needs_Generation").collect()]
        rows_of = specs_rows(mapping_dim, needed)
        regenerate = []
        for name in needed:
            if not any(flag_value(r.get("Is_PK")) for r in rows_of.get(name, [])):
                continue                                              # C-02: nothing to build from
            regenerate.append(name)
            spec = spec_from_mapping(name, rows_of[name], sk_col=f"{name}_SK")
            table = BucketTable(spark, layout.dimension(name))
            old = table.read()
            if old is not None:
                rebuilt, unfit = split_rebuild(old, spec, run_ts)                    # M-06
                store.append(unfit.select(
                    F.lit(audit_id).cast("long").alias("Audit_Source_Import_SK"), F.lit(name).alias("Source_Name"),
                    F.lit(None).cast("string").alias("File_Name"), F.lit(None).cast("long").alias("Row_Number"),
                    "Rejected_Reason", "Raw_Data"), layout.rejects)
                table.write(rebuilt, spec.keys,
                            lambda rows: K.check_active_keys(rows, spec.keys, spec.is_scd2))   # M-08
        if regenerate:
            when = dt.datetime.fromisoformat(run_ts)
            store.append(spark.createDataFrame([(n, "check", when) for n in regenerate],
                                               "Source_Name string, Kind string, "
                                               "Checkpoint_Time timestamp_ntz"), layout.state)  # C-03
            (prints.filter(F.col("Source_Name").isin(regenerate)).withColumn("Checked_At", stamp).coalesce(1)
             .write.mode("append").parquet(layout.fingerprints))
        rows = imports_stg.count() + mapping_stg.count()
        store.append(audit_event(spark, audit_id, 0, SUCCESS, start, dt.datetime.now(), rows, 1,
                                 pattern=pattern, counts=counts["Source_File_Mapping"]), layout.audit)
        return RunReport(SUCCESS, sources=regenerate, counts=counts, rows=rows, files=1)
    except Exception as exc:
        store.append(audit_event(spark, audit_id, 0, FAILED, start, dt.datetime.now(),
                                 detail=str(exc)), layout.audit)
        raise
