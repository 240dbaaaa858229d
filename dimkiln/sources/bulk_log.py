"""Bulk-load error logs as reject rows (F-06 + P-11).

A log is stripped, split into lines numbered from 1, and every non-blank
line that does not start with ``@`` or ``SQLState`` becomes a reject whose
reason is ``BCP_REJECTED: `` + the first 200 characters of the stripped line.
Many logs are read by one text scan (``wholetext`` keeps one row per file),
and the split runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimkiln.functions.text import BULK_PREFIX, prefixed_reason, strip_ws

# Prefixes of log lines that are not row errors.
SKIP_PREFIXES = ("@", "SQLState")


def log_lines(logs: DataFrame, text_col: str, id_cols: list[str]) -> DataFrame:
    """One row per line of each log: ids, ``Line_Number`` (1-based), ``Line``."""
    content = strip_ws(F.col(text_col))
    return logs.select(*id_cols, F.posexplode(F.split(content, "\n")).alias("_pos", "Line")) \
        .select(*id_cols, (F.col("_pos") + 1).alias("Line_Number"), "Line")


def _error_lines(logs: DataFrame, text_col: str, id_cols: list[str]) -> DataFrame:
    """Numbered lines that are row errors: non-blank, not ``@``/``SQLState`` lines."""
    lines = log_lines(logs, text_col, id_cols)
    keep = strip_ws(F.col("Line")) != ""
    for p in SKIP_PREFIXES:
        keep = keep & ~F.col("Line").startswith(p)
    return lines.filter(keep)


def log_rejects(logs: DataFrame, text_col: str, id_cols: list[str]) -> DataFrame:
    """F-06: reject rows from log texts, line numbers kept."""
    return _error_lines(logs, text_col, id_cols).select(
        *id_cols, "Line_Number", prefixed_reason(BULK_PREFIX, F.col("Line")).alias("Rejected_Reason"))


def read_logs(spark: SparkSession, directory: str, pattern: str = "*.log") -> DataFrame:
    """Every log file under ``directory`` as (File_Name, text), one row per file."""
    df = spark.read.option("pathGlobFilter", pattern).text(directory, wholetext=True)
    return df.select(F.col("_metadata.file_name").alias("File_Name"), F.col("value").alias("text"))


def log_reject_rows(logs: DataFrame, text_col: str, source_name: str, audit_id: int,
                    file_col: str = "File_Name") -> DataFrame:
    """F-06 + K-04: reject-table rows for bulk-load log lines.

    Row number is the log line number; the raw data records the line number,
    the stripped error text and the file name.
    """
    lines = _error_lines(logs, text_col, [file_col])
    raw = F.to_json(F.struct(F.col("Line_Number").alias("error_line"),
                             strip_ws(F.col("Line")).alias("bcp_error"),
                             F.col(file_col).alias("file_name")))
    return lines.select(
        F.lit(audit_id).cast("long").alias("Audit_Source_Import_SK"),
        F.lit(source_name).alias("Source_Name"), F.col(file_col).alias("File_Name"),
        F.col("Line_Number").cast("long").alias("Row_Number"),
        prefixed_reason(BULK_PREFIX, F.col("Line")).alias("Rejected_Reason"),
        raw.alias("Raw_Data"))
