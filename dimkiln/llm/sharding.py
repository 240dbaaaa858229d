"""Reproducible shuffle into shards by a Feistel permutation of row numbers.

Rows get global row numbers in (id, text checksum, size) order, and a keyed
Feistel network over the smallest square power-of-four domain that holds all
numbers permutes them; a number that lands outside is permuted again until it
falls inside (cycle walking), which keeps the map a permutation of
0 .. rows - 1. With ``place`` the permuted number, the shard is ``place % shards``
and the slot ``place // shards``: shard counts differ by one row at most, slots
have no gaps, and both follow from row number, row count and seed alone.

Defined cases: a null text counts as no bytes; a null id sorts first; equal rows
take neighbouring numbers in either order, which gives the same table; an empty
table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimkiln.llm.common import python_tasks, read_table, text_of
from dimkiln.operators.keys import assign_sk

ROUNDS = 6
SHARDS = 24
SEED = 2024


def _half_bits(n: int) -> int:
    """Bits of one Feistel half; the domain is 4 ** bits >= n."""
    return max(1, (max(1, n - 1).bit_length() + 1) // 2)


def _round_keys(seed: int) -> list[int]:
    rng = np.random.Generator(np.random.PCG64(seed))
    return [int(k) for k in rng.integers(0, 1 << 62, ROUNDS)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def permute(numbers: np.ndarray, n: int, seed: int = SEED) -> np.ndarray:
    """The permuted place of each number in 0 .. n - 1."""
    bits = np.uint64(_half_bits(n))
    mask = np.uint64((1 << int(bits)) - 1)
    keys = [np.uint64(k) for k in _round_keys(seed)]

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> bits, x & mask
        for k in keys:
            left, right = right, left ^ (_mix(right + k) & mask)
        return (left << bits) | right

    out = once(np.asarray(numbers, dtype=np.uint64))
    outside = np.flatnonzero(out >= np.uint64(n))
    while len(outside):
        out[outside] = once(out[outside])
        outside = outside[out[outside] >= np.uint64(n)]
    return out.astype(np.int64)


def shard_rows(rows: DataFrame, order: list[str], shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``rows`` with ``place`` (permuted row number), ``shard`` and ``slot``."""
    python_tasks(rows.sparkSession)
    numbered = assign_sk(rows, order, "place", start=-1)
    total = rows.count()

    @F.pandas_udf("long")
    def place(number: pd.Series) -> pd.Series:
        return pd.Series(permute(number.to_numpy(), total, seed))

    return (numbered.withColumn("place", place("place"))
            .withColumn("shard", (F.col("place") % shards).cast("int"))
            .withColumn("slot", F.floor(F.col("place") / F.lit(shards)).cast("long")))


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Shard and slot of every document; only ids and checksums are shuffled."""
    text = text_of(text_col)
    rows = docs.select(F.col(id_col), (F.octet_length(text) + 8).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    return shard_rows(rows, [id_col, "text_crc32", "size"], shards, seed)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` in shards 0 to 23 under the ``rows`` law."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return shard_documents(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
