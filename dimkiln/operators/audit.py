"""Audit, lineage and housekeeping operators (K-07, K-08, A-05, O-01, C-03, X-07, P-16).

Audit rows are kept as an append-only event log instead of insert-then-update
(K-07): each run appends one row per status change and readers take the
latest row per run. Every operator is an aggregate with partial
(map-side) aggregation, so a run or file with a huge share of rows is
reduced before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimkiln.sources.files import FILE_NAME, FILE_PATH

# Run status names.
RUNNING, SUCCESS, FAILED, SKIPPED = "Running", "Success", "Failed", "Skipped"


def file_lineage(scanned: DataFrame, audit_id: int = 0, source_import_sk: int = 0,
                 status: str = SUCCESS) -> DataFrame:
    """K-08: one row per file read: name, path, row count, status."""
    return (scanned.groupBy(F.col(FILE_NAME).alias("Original_File_Name"),
                            F.col(FILE_PATH).alias("Archive_Full_Path"))
            .agg(F.count(F.lit(1)).alias("File_Row_Count"))
            .select(F.lit(audit_id).cast("long").alias("Audit_Source_Import_SK"),
                    F.lit(source_import_sk).cast("long").alias("Source_Import_SK"),
                    "Original_File_Name", "Archive_Full_Path", "File_Row_Count",
                    F.lit(status).alias("Process_Status")))


def run_totals(scanned: DataFrame) -> DataFrame:
    """A-05: rows and distinct files of one run (real files, decision D-9)."""
    return scanned.agg(F.count(F.lit(1)).alias("Total_Row_Count"),
                       F.count_distinct(F.col(FILE_PATH)).alias("Total_File_Count"))


def audit_latest(events: DataFrame, run_col: str = "Audit_Source_Import_SK",
                 time_col: str = "Event_Time", status_col: str = "Process_Status",
                 tie_col: str | None = None) -> DataFrame:
    """K-07 + P-16: latest status per run, start, end and duration in seconds.

    ``max_by`` over (time, tie) gives the last event deterministically.
    """
    order = F.struct(F.col(time_col), F.col(tie_col)) if tie_col else F.col(time_col)
    return (events.groupBy(run_col)
            .agg(F.max_by(F.col(status_col), order).alias(status_col),
                 F.min(time_col).alias("Start_Time"), F.max(time_col).alias("End_Time"),
                 F.count(F.lit(1)).alias("Event_Count"))
            .withColumn("Duration_Seconds",
                        F.timestamp_diff("SECOND", F.col("Start_Time"), F.col("End_Time"))))


def audit_top(audit: DataFrame, n: int = 20, time_col: str = "Start_Time",
              tie_col: str = "Audit_Source_Import_SK") -> DataFrame:
    """O-01: the latest ``n`` audit rows by start time (a top-k: the limit is the feature)."""
    return audit.orderBy(F.col(time_col).desc(), F.col(tie_col).desc()).limit(n)


def checkpoint_latest(state: DataFrame, source_col: str, time_col: str, kind_col: str,
                      kinds: dict[str, str]) -> DataFrame:
    """C-03: latest checkpoint per source and kind from an append-only state table.

    ``kinds`` maps a kind value to its output column, e.g.
    ``{"load": "Last_Successful_Load_Datetime", "check": "Last_Checked"}``.
    """
    aggs = [F.max(F.when(F.col(kind_col) == k, F.col(time_col))).alias(name)
            for k, name in kinds.items()]
    return state.groupBy(source_col).agg(*aggs)


def retention_purge(log: DataFrame, time_col: str, run_ts: str, days: int = 7) -> DataFrame:
    """X-07: rows to keep under a retention period (default 7 days) at ``run_ts``.

    ``sinks.store.purge_log`` applies it to a stored log.
    """
    cutoff = F.lit(run_ts).cast("timestamp_ntz") - F.make_interval(days=F.lit(days))
    return log.filter(F.col(time_col) >= cutoff)
