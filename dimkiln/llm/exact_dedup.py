"""Exact de-duplication against a persistent digest index (native).

The index is a Parquet table bucketed and sorted by the SHA-256 digest of the
text. A batch is reduced to one row per digest (partial aggregation, so a text
that a third of all rows share leaves each map task as one row), the digests
already in the index are removed by a sort-merge anti-join that shuffles only
the batch, and the rest is appended.

Law of the index: for each digest the largest id offered so far stays, in whatever
batches the ids come. A larger id for a known digest is appended as one more row of
that digest, and the largest is read. A row is identified by its id and text, never
by its place: a batch offered again, in any partitioning or session, gets the same
decisions.

Defined cases: a null text counts as empty; a null id sorts below every id; ids may
be of any type that sorts; of rows repeating both id and text in a batch exactly one
stays; an empty batch appends nothing; other columns of the input are not read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimkiln.llm.common import materialise, read_table, scratch_path, text_of

DIGEST = "digest"


def stage_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, digest, row): one row per input row, written once to the shared folder.

    ``row`` is unique within the batch; it is fixed by the write.
    """
    staged = docs.select(F.col(id_col).alias("id"),
                         F.sha2(text_of(text_col).cast("binary"), 256).alias(DIGEST),
                         F.monotonically_increasing_id().alias("row"))
    return materialise(staged, "dedup-staged")


class DigestIndex:
    """Digest table at ``path``: (digest, keep_id), bucketed and sorted by digest.

    ``buckets`` must be the same for every session that opens one path; at
    100 TB take some thousands, so that one bucket fits a task. The files are the
    index; the catalog entry, which tells Spark of the buckets, lives from opening
    to ``close``.
    """

    def __init__(self, spark: SparkSession, path: str, id_type: str = "bigint", buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.table = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.table} (digest STRING, keep_id {id_type}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'")

    def __enter__(self) -> DigestIndex:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def close(self) -> None:
        """Drop the catalog entry; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")

    def rows(self) -> DataFrame:
        """All rows of the index, with its bucketing known to the planner."""
        return self.spark.table(self.table)

    def read(self) -> DataFrame:
        """(digest, keep_id): the id that stays for each digest; no shuffle."""
        return self.rows().groupBy(DIGEST).agg(F.max(F.struct("keep_id")).alias("best")).select(
            DIGEST, F.col("best.keep_id").alias("keep_id"))

    def add(self, batch: DataFrame) -> None:
        """Append the digests of ``batch`` (id, digest, row) that the index lacks or has with a smaller id."""
        best = batch.groupBy(DIGEST).agg(F.max(F.struct("id")).alias("best")).select(DIGEST, F.col("best.id").alias("id"))
        known = self.rows().select(F.col(DIGEST).alias("known"), "keep_id").hint("merge")
        covered = F.col("id").isNull() | F.coalesce(F.col("keep_id") >= F.col("id"), F.lit(False))
        fresh = (best.join(known, (F.col(DIGEST) == F.col("known")) & covered, "left_anti")
                 .select(DIGEST, F.col("id").alias("keep_id")))
        (fresh.write.mode("append").format("parquet").bucketBy(self.buckets, DIGEST)
         .sortBy(DIGEST).saveAsTable(self.table))


def decisions(staged: DataFrame, index: DigestIndex) -> DataFrame:
    """(id, keep_id, group_size, kept, digest) for every staged row.

    The per-digest verdicts are written and read back: both sides of the last
    join are then plain shuffles, and Spark can split the partition of a digest
    that many rows share. Of rows repeating id and text the first staged one stays.
    """
    sizes = staged.groupBy(DIGEST).agg(F.count(F.lit(1)).alias("group_size"),
                                       F.max(F.struct("id", (-F.col("row")).alias("row"))).alias("best"))
    # the largest id of the batch is the only one that can be the largest of all
    verdict = materialise(index.read().join(sizes, DIGEST).select(
        DIGEST, "keep_id", "group_size",
        F.when(F.col("best.id").eqNullSafe(F.col("keep_id")), -F.col("best.row")).alias("keep_row")), "dedup-verdict")
    return (staged.join(verdict, DIGEST)
            .select("id", "keep_id", "group_size", F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False)).alias("kept"),
                    DIGEST))


def exact_dedup(docs: DataFrame, index_path: str | None = None, id_col: str = "doc_id",
                text_col: str = "text", buckets: int = 64, batches: int = 2) -> DataFrame:
    """Load ``docs`` into the index at ``index_path`` (a new one if not given) and return the decisions.

    The rows are offered in ``batches`` parts by a hash of their ids; every part but
    the first meets the ones before it through the anti-join.
    """
    spark = docs.sparkSession
    staged = stage_digests(docs, id_col, text_col)
    path = index_path or scratch_path(spark, "digest-index")
    with DigestIndex(spark, path, staged.schema["id"].dataType.simpleString(), buckets) as index:
        part = F.pmod(F.xxhash64("id"), F.lit(batches))
        for i in range(batches):
            index.add(staged.filter(part == i))
        return decisions(staged, index)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``documents`` with the row that stays for its text."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup(docs).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col(DIGEST).alias("text_sha256"))


OP5_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
