"""A dimension stored in buckets of its natural key (K-06), written where it changes.

Rows lie in bucket folders by a hash of their natural key. A manifest names the
folder of every bucket, the key columns, the number of buckets and the schema. A
merge writes new folders for the buckets that hold a changed or new row, then commits
a manifest that names these and the old folders of all others: what is written
follows the changed keys, not the size of the dimension. Folders are never
overwritten and a manifest is committed last, so a reader sees the state before or
after a merge, and a merge that was cut off leaves only unnamed folders behind.

The manifest (one line of JSON) grows with the number of buckets, a parameter of
the table. A single writer is assumed, as for ``SnapshotTable``.
"""

from __future__ import annotations

import json
import re
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dimkiln.session import write_shared
from dimkiln.sinks.store import _children
from dimkiln.sources.files import literal

BUCKET = "_bucket"
BUCKETS = 16
MANIFESTS = "_manifests"
_NUM = re.compile(r"^[wm](\d+)$")


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a row: a hash of its natural key as text."""
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


class BucketTable:
    """Bucket folders under ``root`` and the manifests that name them."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    def _numbers(self, folder: str, committed: bool) -> list[int]:
        return [int(m.group(1)) for n, ok in _children(self.spark, folder)
                if (m := _NUM.match(n)) and (ok or not committed)]

    def version(self) -> int:
        """The number of the newest committed manifest, 0 before the first."""
        return max(self._numbers(f"{self.root}/{MANIFESTS}", True), default=0)

    def manifest(self, version: int | None = None) -> dict | None:
        version = self.version() if version is None else version
        if not version:
            return None
        return json.loads(self.spark.read.text(literal(f"{self.root}/{MANIFESTS}/m{version:06d}")).first()[0])

    def _next(self) -> int:
        # above every folder present, so that one left by a crashed attempt is never reused
        return max(self._numbers(self.root, False) + self._numbers(f"{self.root}/{MANIFESTS}", False), default=0) + 1

    def _rows(self, folders: Sequence[str], schema: StructType) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[literal(f"{self.root}/{f}") for f in folders])

    def read(self) -> DataFrame | None:
        """The rows named by the newest manifest."""
        now = self.manifest()
        return None if now is None else self._rows(list(now["folders"].values()),
                                                   StructType.fromJson(now["schema"]))

    def _write_rows(self, df: DataFrame, number: int, by: str = BUCKET) -> dict[str, str]:
        """Write rows that carry their bucket in ``by``; the folder of each bucket written."""
        base = f"w{number:06d}"
        # rebalancing puts a bucket's rows together and splits a bucket that is too large for one task
        df.hint("rebalance", by).write.partitionBy(by).parquet(f"{self.root}/{base}")
        return {n.split("=", 1)[1]: f"{base}/{n}" for n, _ in _children(self.spark, f"{self.root}/{base}")
                if n.startswith(f"{by}=")}

    def _commit(self, number: int, manifest: dict) -> int:
        (self.spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1)
         .write.text(f"{self.root}/{MANIFESTS}/m{number:06d}"))
        return number

    def write(self, df: DataFrame, keys: Sequence[str],
              validate: Callable[[DataFrame], None] | None = None) -> int:
        """Replace the whole table; ``keys`` decide the buckets from now on.

        ``validate`` sees the rows as written and raises to keep the old state.
        """
        number = self._next()
        folders = self._write_rows(df.withColumn(BUCKET, bucket_of(keys, self.buckets)), number)
        if validate is not None:
            validate(self._rows(list(folders.values()), df.schema))
        return self._commit(number, {"keys": list(keys), "buckets": self.buckets, "schema": df.schema.jsonValue(),
                                     "folders": folders})

    def merge(self, delta: DataFrame, sk: str, validate: Callable[[DataFrame], None] | None = None) -> int:
        """Write the buckets that ``delta`` touches; returns the version now current.

        ``delta`` has the table's columns: new rows, and old rows (same ``sk``, same
        natural key) as they are now. ``validate`` sees all rows, old and new, of
        the natural keys in ``delta`` and raises to keep the old state.
        """
        now = self.manifest()
        if now is None:
            raise ValueError("a table is written whole before it is merged into")
        schema, keys = StructType.fromJson(now["schema"]), now["keys"]
        fresh = write_shared(delta.select(*schema.names).withColumn(BUCKET, bucket_of(keys, now["buckets"])), "delta")
        touched = sorted(str(r[0]) for r in fresh.select(BUCKET).distinct().collect())  # at most one per bucket
        if not touched:
            return self.version()
        old = self._rows([now["folders"][b] for b in touched if b in now["folders"]], schema)
        kept = old.join(fresh.select(sk), sk, "left_anti").select(*schema.names)
        number = self._next()
        rows = kept.withColumn(BUCKET, bucket_of(keys, now["buckets"])).unionByName(fresh)
        folders = self._write_rows(rows, number)
        if validate is not None:
            same = [F.col(f"n.{k}").eqNullSafe(F.col(f"d.{k}")) for k in keys]
            changed = fresh.select(*keys).distinct().alias("d")
            validate(self._rows(list(folders.values()), schema).alias("n").join(changed, same, "left_semi"))
        return self._commit(number, {**now, "folders": {**now["folders"], **folders}})

    def drop_unnamed(self, keep: int = 2) -> list[str]:
        """Delete bucket folders that none of the newest ``keep`` manifests names."""
        versions = sorted(self._numbers(f"{self.root}/{MANIFESTS}", True))[-max(1, keep):]
        held = [f for v in versions for f in self.manifest(v)["folders"].values()]
        named = {f for fs in held for f in ([fs] if isinstance(fs, str) else fs)}
        jvm, gone = self.spark.sparkContext._jvm, []
        for base, committed in _children(self.spark, self.root):
            if not _NUM.match(base) or not base.startswith("w") or not committed:
                continue
            for name, _ in _children(self.spark, f"{self.root}/{base}"):
                folder = f"{base}/{name}"
                if "=" in name and folder not in named:
                    path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{folder}")
                    path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
                    gone.append(folder)
        return gone


def merge_result(table: BucketTable, result, counts: list, validate: Callable[[DataFrame], None] | None = None) -> dict:
    """Write a ``MergeResult`` into its dimension and return its action counts (M-05).

    Only rows with an action are written to the delta; their counts are collected
    in that same job.
    """
    from functools import reduce

    from pyspark.sql import Observation

    from dimkiln.operators.scd import FLAGS
    acted = reduce(lambda a, b: a | b, [F.col(f) for f in FLAGS])
    seen = Observation("merge_counts")
    delta = write_shared(result.flagged.filter(acted).observe(seen, *counts).drop(*FLAGS), "merge-delta")
    table.merge(delta, result.spec.sk, validate)
    return seen.get
