"""Prefix trie of conversations, built as a burst trie.

A turn is the first 16 bytes of the SHA-256 of its role and text, and a
conversation the string of its turns' digests. Equal conversations are merged to
one weighted sequence first. Then:

* a container holds the sequences that start with one head (a path of turns). It
  starts as one container with the empty head;
* a container with more than ``LIMIT`` sequences bursts: its head is extended to
  the longest prefix that all of its sequences share, and they go to containers by
  their next turn. Bursting goes on, all containers at a time, until none is
  oversized, so a turn that very many conversations start with is divided further;
* the containers that remain are dealt to tasks, sorted, and swept: one pass over the
  sorted sequences with a stack of open nodes makes all nodes of a container;
* what burst heads need from their subtrees (leaves, tokens) is added up from the
  last round to the first.

The list of conversations that end at a node can be long; it is hashed as a stream
of pieces made where the sorted ids lie, never as one value.

Result of ``conversation_trie``, one row per node: conv_id (smallest member),
depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256; the
turn of a node is turn number ``depth`` of conversation ``conv_id``.

Defined cases: a null role or text counts as empty; rows without conv_id belong to
no conversation and are left out; turns are ordered with null first, rows of one
turn by their digest; rows repeated are turns repeated; a conversation without turns ends at the
root; an empty table has no nodes, not even a root; other columns are not read. A
conversation's digests and sizes, 24 bytes a turn, form one record, which Spark
limits to 2 GB; its texts never meet in one place.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimkiln.llm.common import materialise, python_tasks, read_table, text_of

LIMIT = 2000
WIDTH = 16
_PIECE_IDS = 4096
_OUT_ROWS = 8192
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, turn_id, size): digest and UTF-8 bytes of every turn, numbered from 1."""
    role, text = text_of("role"), text_of("text")
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256),
                    1, 2 * WIDTH).alias("turn_id"),
        F.octet_length(text).cast("long").alias("size"))
    place = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "turn_id")
    return rows.select("conv_id", F.row_number().over(place).alias("pos"), "turn_id", "size")


def sequences(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """(conv_id, seq, sizes, seq_id) of every conversation in ``ids``; ``turns`` may have gaps in ``pos``."""
    marks = ids.select("conv_id", F.lit(0).alias("pos"), F.lit("").alias("turn_id"), F.lit(0).cast("long").alias("size"))
    rows = turns.select("conv_id", "pos", "turn_id", "size").unionByName(marks)
    listed = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("pos", "turn_id", "size"))).alias("t"))
    seq = F.unhex(F.array_join(F.transform("t", lambda t: t["turn_id"]), ""))
    return (listed.select("conv_id", seq.alias("seq"),
                          F.slice(F.transform("t", lambda t: t["size"]), 2, F.size("t")).alias("sizes"))
            .withColumn("seq_id", F.sha2("seq", 256)))


def end_digests(members: DataFrame) -> DataFrame:
    """(seq_id, ends_sha256): digest of the ascending conversation ids of each sequence.

    Ids are sorted over all tasks and joined to pieces of at most ``_PIECE_IDS``; the
    task that hashes a sequence reads its pieces as a stream.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            out = []
            for seq_id, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if seq_id != now or len(held) == _PIECE_IDS:
                    if held:
                        out.append((now, held[0], ",".join(map(str, held))))
                    now, held = seq_id, []
                held.append(conv)
            yield _batch(out, ["seq_id", "first", "ids"], [pa.string(), pa.int64(), pa.string()])
        if held:
            yield _batch([(now, held[0], ",".join(map(str, held)))], ["seq_id", "first", "ids"],
                         [pa.string(), pa.int64(), pa.string()])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            out = []
            for seq_id, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if seq_id != now:
                    if now is not None:
                        out.append((now, digest.hexdigest()))
                    now, digest = seq_id, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield _batch(out, ["seq_id", "ends_sha256"], [pa.string(), pa.string()])
        if now is not None:
            yield _batch([(now, digest.hexdigest())], ["seq_id", "ends_sha256"], [pa.string(), pa.string()])

    made = (members.select("seq_id", "conv_id").repartitionByRange("seq_id", "conv_id")
            .sortWithinPartitions("seq_id", "conv_id").mapInArrow(pieces, "seq_id string, first long, ids string"))
    return (made.repartition("seq_id").sortWithinPartitions("seq_id", "first").select("seq_id", "ids")
            .mapInArrow(hashed, "seq_id string, ends_sha256 string"))


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


_NODE_NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "end_seq", "up"]
_NODE_TYPES = [pa.int64()] * 7 + [pa.string()] * 2
_NODE_SCHEMA = NODE + ", end_seq string, up string"


class _Open:
    """A node whose subtree is still being read."""

    __slots__ = ("depth", "size", "conv", "n", "children", "leaves", "saved", "end", "waiting")

    def __init__(self, depth: int, size: int):
        self.depth, self.size, self.conv, self.n = depth, size, None, 0
        self.children = self.leaves = self.saved = 0
        self.end, self.waiting = None, []

    def add(self, conv: int, n: int) -> None:
        self.conv = conv if self.conv is None else min(self.conv, conv)
        self.n += n

    def row(self) -> tuple:
        """All but the parent's conversation, which is known once the parent closes."""
        return (self.conv, self.depth, self.n, self.children, max(self.leaves, 1),
                self.saved + (self.n - 1) * self.size, self.end)


def _placed(row: tuple, parent: int | None, up: str | None = None) -> tuple:
    return (row[0], row[1], parent, *row[2:], up)


def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of containers whose sorted sequences follow each other.

    Columns: container, up, parent_conv_id, depth, seq_id, seq, sizes, weight,
    conv_id. The node of a container's head has ``up``, the container it reports to.
    """
    stack: list[_Open] = []
    out: list[tuple] = []
    container, up, parent, last = None, None, None, b""

    def close_to(depth: int) -> None:
        while stack and stack[-1].depth > depth:
            node = stack.pop()
            row = node.row()
            out.extend(_placed(w, node.conv) for w in node.waiting)
            if not stack:
                out.append(_placed(row, parent, up))
                return
            above = stack[-1]
            above.add(node.conv, node.n)
            above.children += 1
            above.leaves += row[4]
            above.saved += row[5]
            above.waiting.append(row)

    for batch in batches:
        for now, now_up, now_parent, depth, seq_id, seq, sizes, weight, conv in zip(
                *(c.to_pylist() for c in batch.columns)):
            if now != container:
                close_to(-1)
                container, up, parent, last = now, now_up, now_parent, seq
                stack.append(_Open(depth, sizes[depth - 1] if depth else 0))
                shared = depth
            else:
                shared, longest = depth, min(len(last), len(seq)) // WIDTH
                while shared < longest and last[WIDTH * shared:WIDTH * (shared + 1)] == seq[WIDTH * shared:WIDTH * (shared + 1)]:
                    shared += 1
                close_to(shared)
                last = seq
            stack.extend(_Open(d, sizes[d - 1]) for d in range(shared + 1, len(sizes) + 1))
            stack[-1].add(conv, weight)
            stack[-1].end = seq_id
            while len(out) >= _OUT_ROWS:
                yield _batch(out[:_OUT_ROWS], _NODE_NAMES, _NODE_TYPES)
                del out[:_OUT_ROWS]
    close_to(-1)
    yield _batch(out, _NODE_NAMES, _NODE_TYPES)


@F.pandas_udf(T.LongType())
def _shared_turns(low: pd.Series, high: pd.Series) -> pd.Series:
    """Turns that the smallest and the largest sequence of a container share."""
    return pd.Series([len(os.path.commonprefix([a, b])) // WIDTH for a, b in zip(low, high)], dtype="int64")


def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of burst heads: one row per depth of the path from ``depth`` to ``last``."""
    for batch in batches:
        for row in batch.to_pylist():
            depths = np.arange(row["depth"], row["last"] + 1)
            sizes = np.array([row["sizes"][d - 1] if d else 0 for d in depths], np.int64)
            below = np.cumsum(sizes[::-1])[::-1]
            m = len(depths)
            yield pa.RecordBatch.from_arrays([
                pa.array([row["conv_id"]] * m, pa.int64()), pa.array(depths, pa.int64()),
                pa.array([row["parent_conv_id"]] + [row["conv_id"]] * (m - 1), pa.int64()),
                pa.array([row["n_convs"]] * m, pa.int64()), pa.array([1] * (m - 1) + [row["n_children"]], pa.int64()),
                pa.array([row["n_leaves"]] * m, pa.int64()),
                pa.array(row["saved_below"] + (row["n_convs"] - 1) * below, pa.int64()),
                pa.array([None] * (m - 1) + [row["end_seq"]], pa.string()),
                pa.array([row["up"]] + [None] * (m - 1), pa.string())], _NODE_NAMES)


def burst(members: DataFrame, limit: int) -> tuple[DataFrame, list[DataFrame]]:
    """The members of containers of at most ``limit`` sequences, and the burst heads of each round."""
    calm, rounds = None, []
    while True:
        big = materialise(members.groupBy("container").agg(F.count(F.lit(1)).alias("held"))
                          .filter(F.col("held") > limit).select("container"), "trie-oversized")
        rest = members.join(big, "container", "left_anti")
        calm = rest if calm is None else calm.unionByName(rest)
        if big.isEmpty():
            return calm, rounds
        whole = (members.join(big, "container", "left_semi").groupBy("container", "up", "parent_conv_id", "depth")
                 .agg(F.min(F.struct("seq", "sizes", "seq_id")).alias("low"), F.max("seq").alias("high"),
                      F.sum("weight").alias("n_convs"), F.min("conv_id").alias("conv_id")))
        heads = whole.withColumn("last", _shared_turns("low.seq", "high")).select(
            "container", "up", "parent_conv_id", "depth", "last", "n_convs", "conv_id",
            F.slice("low.sizes", 1, F.col("last").cast("int")).alias("sizes"),
            F.when(F.length("low.seq") == WIDTH * F.col("last"), F.col("low.seq_id")).alias("end_seq"))
        rounds.append(materialise(heads, "trie-heads"))
        to = rounds[-1].select("container", "last", F.col("conv_id").alias("head_conv"))
        moved = members.join(to, "container").filter(F.length("seq") > WIDTH * F.col("last"))
        turn = F.hex(F.expr(f"substring(seq, cast({WIDTH} * last as int) + 1, {WIDTH})"))
        members = materialise(moved.select(
            F.sha2(F.concat("container", turn).cast("binary"), 256).alias("container"), F.col("container").alias("up"),
            F.col("head_conv").alias("parent_conv_id"), (F.col("last") + 1).alias("depth"), "seq_id", "seq", "sizes",
            "weight", "conv_id"), "trie-members")


def trie(listed: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The nodes of ``sequences`` rows."""
    python_tasks(listed.sparkSession)
    listed = materialise(listed, "trie-sequences")
    groups = listed.groupBy("seq_id", "seq", "sizes").agg(F.count(F.lit(1)).alias("weight"), F.min("conv_id").alias("conv_id"))
    members = materialise(groups.select(
        F.lit("").alias("container"), F.lit(None).cast("string").alias("up"), F.lit(None).cast("long").alias("parent_conv_id"),
        F.lit(0).cast("long").alias("depth"), "seq_id", "seq", "sizes", "weight", "conv_id"), "trie-members")
    calm, rounds = burst(members, limit)
    swept = calm.select("container", "up", "parent_conv_id", "depth", "seq_id", "seq", "sizes", "weight", "conv_id")
    nodes = materialise(swept.repartition("container").sortWithinPartitions("container", "seq")
                        .mapInArrow(sweep, _NODE_SCHEMA), "trie-nodes")
    for heads in reversed(rounds):
        reports = (nodes.filter(F.col("up").isNotNull()).groupBy(F.col("up").alias("container"))
                   .agg(F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
                        F.sum("saved_tokens").alias("saved_below")))
        made = materialise(heads.join(reports, "container").mapInArrow(unfold, _NODE_SCHEMA), "trie-heads")
        nodes = nodes.unionByName(made)
    return (nodes.join(end_digests(listed).withColumnRenamed("seq_id", "end_seq"), "end_seq", "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256")))


def conversation_trie(conversations: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The prefix trie of ``conversations`` (conv_id, turn, role, text)."""
    turns = materialise(turn_rows(conversations), "trie-turns")
    return trie(sequences(turns, turns.select("conv_id").distinct()), limit)


def shared_openings(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on their neighbours' openings, as ``turn_rows``, and their ids.

    Conversation c gets the first h turns of conversation c - c % 5 (floor) before its
    own turns after the first h; h = crc32(decimal c) % 9.
    """
    ids = turns.filter("pos = 1").select("conv_id")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    own = turns.filter(F.col("pos") > h)
    lent = (turns.filter((F.pmod("conv_id", F.lit(5)) == 0) & (F.col("pos") <= 8))
            .withColumn("next", F.explode(F.sequence(F.lit(0), F.lit(4))))
            .withColumn("conv_id", F.col("conv_id") + F.col("next")).drop("next")
            .filter(F.col("pos") <= h).join(ids, "conv_id", "left_semi"))
    return own.unionByName(lent), ids


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of all ``conversations``, each rebuilt on its neighbour's opening."""
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns, ids = shared_openings(materialise(turn_rows(rows), "trie-turns"))
    return trie(sequences(turns, ids))


OP13_SQL = """
WITH bytes AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
    lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
digested AS (
  SELECT conv_id, turn, strlen(coalesce(text, '')) AS size,
         sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))[1:32] AS turn_id
  FROM conversations WHERE conv_id IS NOT NULL),
turns AS (
  SELECT conv_id, turn_id, size, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, turn_id) AS pos
  FROM digested),
ids AS (
  SELECT conv_id, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x))),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM turns), bytes),
rebuilt AS (
  SELECT i.conv_id, t.pos, t.turn_id, t.size FROM ids i JOIN turns t ON t.conv_id = i.conv_id - (i.conv_id % 5 + 5) % 5 AND t.pos <= i.h
  UNION ALL SELECT i.conv_id, t.pos, t.turn_id, t.size FROM ids i JOIN turns t ON t.conv_id = i.conv_id AND t.pos > i.h),
seqs AS (
  SELECT i.conv_id, coalesce(list(r.turn_id ORDER BY r.pos) FILTER (r.pos IS NOT NULL), []) AS seq,
         coalesce(list(r.size ORDER BY r.pos) FILTER (r.pos IS NOT NULL), []) AS sizes
  FROM ids i LEFT JOIN rebuilt r ON r.conv_id = i.conv_id GROUP BY i.conv_id),
prefixes AS (
  SELECT conv_id, d, list_slice(seq, 1, d) AS path, CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS size, d = len(seq) AS ends
  FROM (SELECT *, unnest(range(0, len(seq) + 1)) AS d FROM seqs)),
nodes AS (
  SELECT d AS depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM prefixes GROUP BY d, path),
kids AS (
  SELECT depth - 1 AS depth, list_slice(path, 1, depth - 1) AS path, count(*) AS n_children
  FROM nodes WHERE depth > 0 GROUP BY ALL),
counted AS (
  SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN kids k ON k.depth = n.depth AND k.path = n.path),
subtrees AS (
  SELECT d AS depth, list_slice(path, 1, d) AS path, sum((n_convs - 1) * size) AS saved, count(*) FILTER (n_children = 0) AS leaves
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM counted) GROUP BY ALL)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, s.leaves AS n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, c.ends_sha256
FROM counted c JOIN subtrees s ON s.depth = c.depth AND s.path = c.path
LEFT JOIN counted p ON p.depth = c.depth - 1 AND p.path = list_slice(c.path, 1, c.depth - 1)
"""
