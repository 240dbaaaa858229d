"""Surrogate keys (M-10) and the active natural-key constraint (M-08).

``assign_sk`` numbers rows 1..N in key order without pulling them into one
partition: the rows are range-partitioned on the order columns and sorted
inside each partition, checkpointed so that every later read sees the same
partitions, counted per partition, and each row gets
``start + rows in earlier partitions + position in its partition``. Only the
per-partition counts (one number per partition) reach the driver, and the
offsets are broadcast back, so both have a proven bound: the partition count.
"""

from __future__ import annotations

from typing import Iterable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimkiln.session import checkpoint_dir
from dimkiln.spec import IS_CURRENT, IS_DELETED

_PID = "_sk_pid"
_POS = "_sk_pos"
_OFF = "_sk_off"
_CNT = "_sk_cnt"


def sk_start(dim: DataFrame, sk_col: str) -> Column:
    """Largest surrogate key in use as a scalar subquery (0 when empty).

    Evaluated inside the plan that needs it: no round trip through the driver.
    """
    return F.coalesce(dim.agg(F.max(F.col(sk_col))).scalar(), F.lit(0)).cast("long")


def assign_sk(df: DataFrame, order_cols: Iterable[str | Column], sk_col: str,
              start: int | Column = 0, num_partitions: int | None = None,
              checkpoint: bool = True) -> DataFrame:
    """Add ``sk_col`` = start + dense position in ``order_cols`` order (1-based).

    ``start`` is a number or a scalar Column such as ``sk_start(dim, sk)``.
    """
    spark = df.sparkSession
    order = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    src = df
    if checkpoint:
        # range partitioning samples its input and then shuffles it: keep the
        # input so both passes read one computation
        src = df.persist(StorageLevel.MEMORY_AND_DISK)
    ranged = (src.repartitionByRange(num_partitions, *order) if num_partitions
              else src.repartitionByRange(*order)).sortWithinPartitions(*order)
    if checkpoint:
        # A retry must see the same partitions and the same order inside them,
        # so cut the lineage in the shared checkpoint folder (never a local one).
        checkpoint_dir(spark)
        ranged = ranged.checkpoint(eager=True)
        src.unpersist()
    tagged = ranged.withColumn(_PID, F.spark_partition_id()).withColumn(
        _POS, F.monotonically_increasing_id() - F.shiftleft(F.col(_PID).cast("long"), 33))
    # one count per partition (a bound set by the partition count) reaches the
    # driver; the running offsets go back as a broadcast of the same size
    counts = sorted((r[_PID], r[_CNT]) for r in
                    tagged.groupBy(_PID).agg(F.count(F.lit(1)).alias(_CNT)).collect())
    running, rows = 0, []
    for pid, cnt in counts:
        rows.append((pid, running))
        running += cnt
    offsets = spark.createDataFrame(rows, f"{_PID} int, {_OFF} long")
    return (tagged.join(F.broadcast(offsets), _PID, "inner")
            .withColumn(sk_col, ((start if isinstance(start, Column) else F.lit(start))
                                 + F.col(_OFF) + F.col(_POS) + 1).cast("long"))
            .drop(_PID, _POS, _OFF))


def active_key_violations(dim: DataFrame, keys: Iterable[str], scd2: bool) -> DataFrame:
    """M-08: natural keys held by more than one active row.

    Active = not deleted, and current for Type 2. Partial aggregation keeps a
    hot key from reaching one task as raw rows. Empty result = constraint holds.
    """
    active = F.col(IS_DELETED) == 0
    if scd2:
        active = active & (F.col(IS_CURRENT) == 1)
    keys = list(keys)
    return (dim.filter(active).groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("active_rows"))
            .filter(F.col("active_rows") > 1))


def check_active_keys(dim: DataFrame, keys: Iterable[str], scd2: bool) -> None:
    """Raise when ``active_key_violations`` is not empty (a failed write)."""
    bad = active_key_violations(dim, keys, scd2).limit(5).collect()
    if bad:
        raise ValueError(f"active natural key not unique, e.g. {[r.asDict() for r in bad]}")
