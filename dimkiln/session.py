"""Session helpers: configuration every job here relies on.

On a cluster the session is built by the platform; ``tune`` only sets what is
unset, and ``checkpoint_dir`` reads the shared folder named by the cluster in
``spark.checkpoint.dir``. A local folder is set only when nothing is
configured (tests and local benches).
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on; applied only where the session leaves them unset.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # rows handed to Python tasks are batched by bytes as well as by count
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
    # parquet files keep naive timestamps naive
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    # HotSpot never compiles a method above 8000 bytes of code: a stage whose generated loop is
    # larger (a typed load of a dozen columns) runs operator by operator, in methods it does compile
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "dimkiln", extra: dict | None = None) -> SparkSession:
    """Local session for tests and benches (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("DIMKILN_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Starting points for a large cluster (1000 executors, ~100 TB inputs); AQE
# coalesces small shuffle partitions, so the shuffle count is set high.
CLUSTER_SETTINGS = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the defaults above where the session has no value of its own."""
    for k, v in _DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder of this session.

    Uses the folder already set on the context or named in
    ``spark.checkpoint.dir`` (the shared folder of the cluster). Only a
    local-mode session (tests, local benches) with nothing configured gets a
    fresh local folder; on a cluster a missing setting is an error, since a
    machine-local folder would not survive the loss of that machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = sc.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, object store)")
        named = tempfile.mkdtemp(prefix="dimkiln-ckpt-", dir="/tmp")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir() or named


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the executors, once per application.

    Python tasks import it by name; Spark's own file distribution takes it to
    every executor, also to those that join later. Every function that starts
    Python tasks calls this first.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(package)
    path = os.path.join(tempfile.mkdtemp(prefix="ship-"), f"{os.path.basename(package)}-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def write_shared(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh place in the shared checkpoint folder and read it back.

    The files outlive any executor, and their measured size lets a later join
    be broadcast only below ``spark.sql.autoBroadcastJoinThreshold``; above
    it the join is a plain shuffle whose skewed partitions AQE can split.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table_dir(spark: SparkSession) -> str:
    """A fresh folder for tables a query writes and reads back: under the warehouse."""
    root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    return f"{root}/dimkiln/{uuid.uuid4().hex}"
