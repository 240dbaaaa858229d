"""Sinks (K-01, K-03, K-04, K-05, K-06, K-07, K-08, K-09).

Built-in Parquet tables refuse ``MERGE INTO``/``UPDATE`` and a job cannot
overwrite the path it reads, so a dimension is stored as immutable snapshot
directories plus a one-line pointer: a merge reads the current snapshot,
writes the next one, then moves the pointer (single writer assumed). The old
snapshot stays as the backup a rebuild needs. Logs (rejects, audit events,
lineage, errors) are append-only tables partitioned by source.

All paths are on the shared store the cluster uses; nothing is written to a
machine-local folder.
"""

from __future__ import annotations

import re
import uuid
from typing import Callable, Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dimkiln.functions.text import error_line

POINTERS = "_pointers"
_NUM = re.compile(r"^[vp](\d+)$")


def _children(spark: SparkSession, folder: str) -> list[tuple[str, bool]]:
    """(name, committed) of the sub-folders of ``folder`` on the cluster's file system."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    out = []
    for st in fs.listStatus(path):
        if st.isDirectory():
            done = fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS"))
            out.append((st.getPath().getName(), bool(done)))
    return out


class SnapshotTable:
    """K-06: a table as numbered snapshot folders plus numbered pointers.

    A write goes to a new folder ``vN`` (N above every folder present, so a
    folder left by a crashed attempt is never reused), then a new pointer
    ``_pointers/pN`` naming it is committed. Pointers are never overwritten:
    a reader takes the highest committed one, so it never sees a missing or
    half-written pointer while a writer switches.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def current_path(self) -> str | None:
        done = [(int(m.group(1)), n) for n, ok in _children(self.spark, f"{self.root}/{POINTERS}")
                if ok and (m := _NUM.match(n))]
        if not done:
            return None
        latest = max(done)[1]
        row = self.spark.read.text(f"{self.root}/{POINTERS}/{latest}").first()
        return row["value"].strip() if row else None

    def read(self) -> DataFrame | None:
        path = self.current_path()
        return self.spark.read.parquet(path) if path else None

    def _next_number(self) -> int:
        nums = [int(m.group(1)) for n, _ in _children(self.spark, self.root) if (m := _NUM.match(n))]
        nums += [int(m.group(1)) for n, _ in _children(self.spark, f"{self.root}/{POINTERS}")
                 if (m := _NUM.match(n))]
        return max(nums, default=0) + 1

    def write(self, df: DataFrame, partition_by: Iterable[str] | None = None,
              validate: Callable[[DataFrame], None] | None = None) -> str:
        """Write ``df`` as the next snapshot, then commit a pointer to it.

        ``validate`` sees the rows as written and raises to keep the old
        snapshot current.
        """
        n = self._next_number()
        path = f"{self.root}/v{n:06d}"
        w = df.write.mode("errorifexists")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
        if validate is not None:
            validate(self.spark.read.parquet(path))
        (self.spark.createDataFrame([(path,)], "value string").coalesce(1)
         .write.mode("errorifexists").text(f"{self.root}/{POINTERS}/p{n:06d}"))
        return path


def drop_snapshots(table: SnapshotTable, keep: int = 2) -> list[str]:
    """Delete all but the newest ``keep`` committed snapshots; never the current one."""
    jvm = table.spark.sparkContext._jvm
    done = sorted(n for n, ok in _children(table.spark, table.root) if ok and _NUM.match(n))
    old = done[:-max(1, keep)]
    for name in old:
        path = jvm.org.apache.hadoop.fs.Path(f"{table.root}/{name}")
        path.getFileSystem(table.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return old


def write_staging(df: DataFrame, path: str, partition_by: Iterable[str] | None = None) -> None:
    """K-01: truncate-then-load of a transient staging table."""
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def append(df: DataFrame, path: str, partition_by: Iterable[str] | None = ("Source_Name",)) -> None:
    """K-04/K-07/K-08/K-09: append to a log table, partitioned by source."""
    w = df.write.mode("append")
    cols = [c for c in (partition_by or ()) if c in df.columns]
    if cols:
        w = w.partitionBy(*cols)
    w.parquet(path)


ATTEMPT = "Attempt"


def new_attempt() -> str:
    """A name for one attempt at a load; it never looks like a number, so it stays text as a partition."""
    return f"a-{uuid.uuid4().hex}"


def append_attempt(df: DataFrame, path: str, attempt: str) -> None:
    """K-04/K-08: append log rows under one attempt; they count once it is committed."""
    append(df.withColumn(ATTEMPT, F.lit(attempt)), path, ("Source_Name", ATTEMPT))


def commit_attempt(spark: SparkSession, path: str, source: str, run_id: int, attempt: str) -> None:
    """Name ``attempt`` as the one whose log rows count for this source and run; the last step of a load."""
    row = spark.createDataFrame([(source, int(run_id), attempt)], f"Source_Name string, Audit_Source_Import_SK long, {ATTEMPT} string")
    row.withColumn("Committed_At", F.current_timestamp().cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(path)


def committed(log: DataFrame, commits: DataFrame) -> DataFrame:
    """The rows of a log that count: those of the last committed attempt of each source and run.

    A load that failed after it had written log rows leaves them without a commit;
    repeating it, under the same run or a new one, therefore leaves each row once.
    """
    last = (commits.groupBy("Source_Name", "Audit_Source_Import_SK")
            .agg(F.max_by(ATTEMPT, F.struct("Committed_At", ATTEMPT)).alias(ATTEMPT)))
    return log.join(last.select("Source_Name", ATTEMPT), ["Source_Name", ATTEMPT], "left_semi").drop(ATTEMPT)


def purge_log(table: SnapshotTable, time_col: str, run_ts: str, days: int = 7) -> int:
    """X-07: rewrite a log kept as a snapshot table without its expired rows.

    Returns the number of rows purged. The snapshot before stays until
    ``drop_snapshots`` removes it.
    """
    from dimkiln.operators.audit import retention_purge
    log = table.read()
    if log is None:
        return 0
    before = log.count()
    table.write(retention_purge(log, time_col, run_ts, days))
    return before - table.read().count()


def write_with_counts(df: DataFrame, table: SnapshotTable, counts: list,
                      name: str = "merge_counts",
                      validate: Callable[[DataFrame], None] | None = None) -> tuple[str, dict]:
    """Write a merge result and collect its action counts in the same job (M-05).

    ``counts`` are aggregate Columns over the flag columns of ``df``; the
    flags are dropped before the rows are written.
    """
    obs = Observation(name)
    flags = [c for c in df.columns if c.startswith("_") and len(c) == 2]
    path = table.write(df.observe(obs, *counts).drop(*flags), validate=validate)
    return path, obs.get


def write_reject_csv(rejects: DataFrame, path: str, run_ts: str) -> None:
    """K-05: per-source reject file, overwritten each run.

    Header ``Inserted_Datetime,Rejected_Reason,Raw_Data``; newlines inside
    values are written as the two characters ``\\n``; quotes are doubled.
    Spark writes a folder of part files; the parsed content is the same.
    """
    esc = lambda c: F.regexp_replace(F.col(c), "\n", "\\\\n")
    out = rejects.select(F.lit(run_ts).alias("Inserted_Datetime"),
                         esc("Rejected_Reason").alias("Rejected_Reason"),
                         esc("Raw_Data").alias("Raw_Data"))
    (out.write.mode("overwrite").option("header", True).option("quote", '"')
     .option("escape", '"').option("quoteAll", True).csv(path))


def export_staging_text(df: DataFrame, path: str) -> None:
    """K-03: tab-separated text, no header, CRLF line ends, NULL as empty."""
    line = F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns])
    df.select(line.alias("value")).write.mode("overwrite").option("lineSep", "\r\n").text(path)


def error_row(spark: SparkSession, operator: str, exc: BaseException, source_name: str,
              run_id: int) -> DataFrame:
    """K-09: one error fact row for a failed merge (driver-side, one row)."""
    sql_state = getattr(exc, "getSqlState", lambda: None)() if hasattr(exc, "getSqlState") else None
    err_class = getattr(exc, "getErrorClass", lambda: None)() if hasattr(exc, "getErrorClass") else None
    return spark.createDataFrame(
        [(operator, err_class or type(exc).__name__, sql_state, str(exc), error_line(exc),
          source_name, int(run_id))],
        "Procedure_Name string, Error_Class string, Sql_State string, Error_Message string, "
        "Error_Summary string, Source_Name string, Audit_Source_Import_SK long")


def load_fact(df: DataFrame, path: str, strategy: str = "append",
              partition_by: Iterable[str] | None = None) -> None:
    """X-04: load a fact table by truncate-and-load or append.

    ``truncate`` replaces the table (whole-table overwrite); ``append`` adds
    rows; ``replace_partitions`` overwrites only the partitions present in
    ``df`` (dynamic partition overwrite), the idempotent form of a reload.
    """
    w = df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    if strategy == "truncate":
        w.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    elif strategy == "append":
        w.mode("append").parquet(path)
    elif strategy == "replace_partitions":
        if not partition_by:
            raise ValueError("replace_partitions needs partition columns")
        w.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        raise ValueError(f"unknown load strategy {strategy!r}")
