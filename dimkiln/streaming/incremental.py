"""Incremental fact load as a file stream (X-03, X-04).

New files under a source folder are picked up by Structured Streaming's
file source with ``trigger(availableNow=True)``: every file not yet in the
stream's checkpoint is processed once, in bounded micro-batches, and the
query stops. Each micro-batch keeps the rows above the high-water mark and is
appended (or replaces the table, X-04) by ``foreachBatch``. The target is
partitioned by load and batch: the load is named after its checkpoint, so a
retried batch rewrites only its own partition and two loads never touch each
other's. The checkpoint location is the caller's, in a folder that outlives
the session, so a restarted driver resumes where the last batch ended.

``load_increment`` is the batch form: it reads the stored high-water mark,
appends the rows above it and those at it that are new, and stores the new mark.
"""

from __future__ import annotations

import hashlib
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dimkiln.sources.files import path_exists

LOAD_ID = "load_id"
BATCH_ID = "batch_id"
MARK = "High_Water_Mark"
NUMBER = "Load_Number"


def load_id_of(checkpoint_location: str) -> str:
    """The name of a load: a digest of where its checkpoint lies."""
    return hashlib.sha256(checkpoint_location.rstrip("/").encode()).hexdigest()[:16]


def incremental_stream(spark: SparkSession, source_dir: str, schema: StructType, ts_col: str,
                       high_water_mark: str, target_path: str, checkpoint_location: str,
                       pattern: str | None = None, mode: str = "append",
                       max_files_per_trigger: int | None = None,
                       transform: Callable[[DataFrame], DataFrame] | None = None) -> str:
    """Load rows with ``ts_col > high_water_mark`` from new files into ``target_path``.

    ``source_dir`` is the folder watched; ``pattern`` limits it to matching
    file names.

    ``mode`` is the X-04 strategy: ``append`` adds each batch, ``truncate``
    replaces the table with the first batch and appends the rest. Calling
    again with the same ``checkpoint_location`` continues that load; another
    location is another load into the same table. Returns the load id.
    """
    if not checkpoint_location:
        raise ValueError("a load needs a checkpoint location of its own")
    load_id = load_id_of(checkpoint_location)
    reader = spark.readStream.schema(schema).format("parquet")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(source_dir).filter(
        F.col(ts_col) > F.lit(high_water_mark).cast("timestamp_ntz"))
    if transform is not None:
        stream = transform(stream)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # A retried batch rewrites only its own partition (dynamic overwrite);
        # ``truncate`` replaces the whole table with the first batch.
        static = mode == "truncate" and batch_id == 0
        (batch.withColumn(LOAD_ID, F.lit(load_id)).withColumn(BATCH_ID, F.lit(batch_id).cast("long")).write
         .partitionBy(LOAD_ID, BATCH_ID).mode("overwrite")
         .option("partitionOverwriteMode", "static" if static else "dynamic")
         .parquet(target_path))

    q = (stream.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint_location)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return load_id


def read_loaded(spark: SparkSession, target_path: str) -> DataFrame:
    """The loaded rows without the load columns."""
    return spark.read.parquet(target_path).drop(LOAD_ID, BATCH_ID)


def stored_mark(spark: SparkSession, state_path: str, name: str) -> str | None:
    """X-03: the highest mark stored for ``name``, None before its first load."""
    return _state(spark, state_path, name)[0]


def _state(spark: SparkSession, state_path: str, name: str) -> tuple[str | None, int]:
    """(mark, number of the last load of ``name``)."""
    if not path_exists(spark, state_path):
        return None, 0
    row = (spark.read.parquet(state_path).filter(F.col("Name") == name)
           .agg(F.max(MARK).cast("string"), F.max(NUMBER)).first())
    return row[0], int(row[1] or 0)


def _digest(columns: list[str]) -> Column:
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def load_increment(spark: SparkSession, fact: DataFrame, ts_col: str, target_path: str, state_path: str,
                   name: str) -> str | None:
    """X-03: append the rows of ``fact`` that are not loaded yet, then store the new mark.

    Without a stored mark all rows are loaded, those with a NULL time too.
    Afterwards rows above the mark are loaded, and rows at the mark's own time
    whose digest is not among those loaded at that time: a row that arrives late
    with the same time is loaded once. (Rows equal in every column are one row
    there.) The digests of the rows at the mark are a table beside the state, one
    row each, joined by digest; they count once the state names their load.

    The load's partition is named after the state it started from, so a load
    cut off before its state was stored is repeated into the same partition.
    Returns the mark now stored.
    """
    mark, number = _state(spark, state_path, name)
    boundary_path = f"{state_path.rstrip('/')}_boundary"
    columns = fact.columns
    rows = fact
    if mark is not None:
        at = F.lit(mark).cast("timestamp_ntz")
        seen = spark.read.parquet(boundary_path).filter(
            (F.col("Name") == name) & (F.col(MARK) == at) & (F.col(NUMBER) <= number)).select("Digest").distinct()
        late = (fact.filter(F.col(ts_col) == at).withColumn("Digest", _digest(columns))
                .join(seen, "Digest", "left_anti").select(*columns))
        rows = fact.filter(F.col(ts_col) > at).unionByName(late)
    load_id = load_id_of(f"{name}/{number}/{mark}")
    (rows.withColumn(LOAD_ID, F.lit(load_id)).withColumn(BATCH_ID, F.lit(0).cast("long")).write
     .partitionBy(LOAD_ID, BATCH_ID).mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .parquet(target_path))
    loaded = spark.read.parquet(target_path).filter(F.col(LOAD_ID) == load_id)
    top = loaded.agg(F.max(ts_col).cast("timestamp_ntz")).first()[0]
    if top is None:  # nothing new, or nothing with a time
        return mark
    here = F.lit(top).cast("timestamp_ntz")
    tags = [F.lit(name).alias("Name"), here.alias(MARK), F.lit(number + 1).cast("long").alias(NUMBER)]
    (loaded.filter(F.col(ts_col) == here).select(*tags, _digest(columns).alias("Digest")).distinct()
     .write.mode("append").parquet(boundary_path))
    spark.range(1).select(*tags).coalesce(1).write.mode("append").parquet(state_path)
    return stored_mark(spark, state_path, name)
