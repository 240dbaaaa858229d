"""Helpers shared by the operators of this subpackage.

Intermediate tables go to the shared folder the session names in
``spark.checkpoint.dir`` (see ``dimkiln.session.checkpoint_dir``); nothing is
written to a machine-local folder on a cluster.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimkiln.session import checkpoint_dir, ship_package, write_shared

# Arrow batches handed to Python tasks are cut by bytes as well as by rows, so
# a batch of very long texts stays within a task's memory.
_ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_ARROW_BATCH_BYTES = 16 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def python_tasks(spark: SparkSession) -> None:
    """Prepare a session for Python tasks: the package on every executor, and
    Arrow batches bounded by bytes unless the session has a tighter bound. The bound
    stays set, since frames are computed long after they are described."""
    ship_package(spark)
    now = spark.conf.get(_ARROW_BYTES, None)
    if now is None or not now.isdigit() or int(now) > _ARROW_BATCH_BYTES:
        spark.conf.set(_ARROW_BYTES, str(_ARROW_BATCH_BYTES))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (``session.write_shared``)."""
    return write_shared(df, name)


def text_of(col: str | Column) -> Column:
    """The text, with null read as empty."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c, F.lit(""))


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that no column of ``df`` has (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name
