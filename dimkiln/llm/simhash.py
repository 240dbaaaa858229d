"""SimHash near-duplicates by multi-index hashing.

A text's fingerprint has 64 bits: a bit is set when it is set in over half of the
XXH64 values of the text's word shingles. Fingerprints link at ``distance`` or
fewer differing bits. With two segments of 32 bits, one segment of two linked
fingerprints differs in at most ``distance // 2`` bits (pigeonhole). So every
distinct fingerprint is entered in one table per segment, the small Hamming ball
around each of its segments is enumerated, table rows with an enumerated segment
value are fetched by a hash join, and the whole distance is verified.

Rows with equal fingerprints are merged first, so copies cost nothing. What is
left is skew between *different* fingerprints: a segment value that more than
``dense`` distinct fingerprints share. There pairs are not formed; each
fingerprint is sent to the values of its other segment within a few flipped
bits, such that all who meet at a value are linked through one of them: with
``near`` within distance // 2 of the value and ``far`` within the rest, near plus
far never exceeds the distance, and any linked pair meets at some value. One
value meets a bounded number of fingerprints (the size of that ball). Both ways
find the same components.

Defined cases: a null text counts as empty, empty texts have fingerprint 0 and
link like others; rows with equal text or id are each returned; an empty table
gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimkiln.llm.common import free_name, materialise, python_tasks, read_table
from dimkiln.llm.components import components

SEED = 42
SHINGLE = 3
DISTANCE = 3
SEGMENT_BITS = 32
DENSE = 256
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint of one text.

    A-Z are lowered and words end at ASCII white space, which is what ``lower``
    and ``split`` do on bytes. Shingles are counted in chunks, so a very long
    text needs memory for its words and one chunk of hashes only.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))
    width = min(shingle, len(words))
    first = starts[: len(words) - width + 1].tolist()
    last = (ends[width - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(first), _CHUNK):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(first[at:at + _CHUNK], last[at:at + _CHUNK])],
                          dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_bits = np.flatnonzero(2 * counts > len(first))
    return sum(1 << int(b) for b in set_bits)


def with_fingerprint(docs: DataFrame, out_col: str, text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with the fingerprint as a signed long."""
    python_tasks(docs.sparkSession)

    @F.pandas_udf("long")
    def udf(texts: pd.Series) -> pd.Series:
        prints = np.array([fingerprint(t if isinstance(t, str) else None, shingle) for t in texts], dtype=np.uint64)
        return pd.Series(prints.view(np.int64))

    return docs.withColumn(out_col, udf(F.col(text_col)))


def _ball(radius: int, bits: int = SEGMENT_BITS) -> list[int]:
    """All masks of at most ``radius`` of ``bits`` bits."""
    return [sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(bits), r)]


def _masks(radius: int) -> Column:
    return F.array(*[F.lit(m).cast("long") for m in _ball(radius)])


def _segments(prints: DataFrame) -> DataFrame:
    """(fp, part, seg, rest): each fingerprint once per segment, with the other segment."""
    low = F.col("fp").bitwiseAND(F.lit((1 << SEGMENT_BITS) - 1))
    high = F.shiftrightunsigned("fp", SEGMENT_BITS)
    parts = F.array(F.struct(F.lit(0).alias("part"), low.alias("seg"), high.alias("rest")),
                    F.struct(F.lit(1).alias("part"), high.alias("seg"), low.alias("rest")))
    return prints.select("fp", F.inline(parts))


def _probes(table: DataFrame, radius: int) -> DataFrame:
    """The ball around each segment; ``off`` counts the flipped bits."""
    mask = F.explode(_masks(radius))
    flipped = table.select("fp", "part", "seg", "rest", mask.alias("mask"))
    return flipped.select("fp", "part", F.col("seg").bitwiseXOR(F.col("mask")).alias("seg"), "rest",
                          F.bit_count("mask").alias("off"))


def links(prints: DataFrame, distance: int = DISTANCE, dense: int = DENSE) -> DataFrame:
    """Edges (u, v) between distinct fingerprints whose closure is that of all links.

    ``prints`` has the distinct fingerprints in ``fp``.
    """
    radius = distance // 2
    table = _segments(prints)
    crowded = materialise(table.groupBy("part", "seg").count().filter(F.col("count") > dense)
                          .select("part", "seg"), "simhash-crowded")
    probes = _probes(table, radius)
    none_crowded = crowded.isEmpty()
    entries = table if none_crowded else table.join(crowded, ["part", "seg"], "left_anti")
    pairs = (probes.select(F.col("fp").alias("u"), "part", "seg")
             # size estimates do not see the ball's growth, so neither side may be broadcast on them
             .join(entries.select(F.col("fp").alias("v"), "part", "seg").hint("merge"), ["part", "seg"])
             .filter((F.col("u") < F.col("v"))
                     & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= distance))
             .select("u", "v"))
    if none_crowded:
        return pairs
    return pairs.union(_crowded_links(probes.join(crowded, ["part", "seg"], "left_semi"), distance))


def _crowded_links(visits: DataFrame, distance: int) -> DataFrame:
    """Links inside crowded segment values.

    A visitor with ``off`` flipped segment bits goes to every value of its other
    segment within ``distance - near - off`` flips. Members (off 0) that come
    within ``near`` flips of a value are its centres: any centre links to all
    visitors of the value.
    """
    near = distance // 2
    rows = []
    for off in range(near + 1):
        mask = F.explode(_masks(distance - near - off))
        rows.append(visits.filter(F.col("off") == off)
                    .select("fp", "part", "seg", "rest", mask.alias("mask"))
                    .select("fp", "part", "seg", F.col("rest").bitwiseXOR(F.col("mask")).alias("value"),
                            (F.lit(off == 0) & (F.bit_count("mask") <= near)).alias("centre")))
    met = rows[0]
    for more in rows[1:]:
        met = met.union(more)
    stars = (met.groupBy("part", "seg", "value")
             .agg(F.min(F.when(F.col("centre"), F.col("fp"))).alias("u"), F.collect_set("fp").alias("all"))
             .filter(F.col("u").isNotNull() & (F.size("all") > 1)))
    return stars.select("u", F.explode("all").alias("v")).filter(F.col("u") != F.col("v")).distinct()


def _rooted(rows: DataFrame, distance: int, dense: int) -> DataFrame:
    """(fp, least, root) of every fingerprint of ``rows`` (id, fp, ...), with its smallest id and its component."""
    prints = materialise(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash-prints")
    roots = components(links(prints.select("fp"), distance, dense))
    return (prints.join(roots, prints["fp"] == roots["node"], "left")
            .select("fp", "least", F.coalesce("root", "fp").alias("root")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    distance: int = DISTANCE, dense: int = DENSE) -> DataFrame:
    """(id, fp, component_id) of every row; the component is named by its smallest id."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = materialise(with_fingerprint(texts, "fp", "text", shingle).select("id", "fp"), "simhash-rows")
    rooted = _rooted(rows, distance, dense)
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    verdict = materialise(rooted.join(named, "root").select("fp", "component_id"), "simhash-verdict")
    return rows.join(verdict, "fp").select("id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             distance: int = DISTANCE) -> DataFrame:
    """``docs`` with one row of each component: the one with its smallest id.

    Rows are told apart by id and by hashes of all their columns, so the choice does
    not depend on the order of rows: of rows repeating the smallest id the one with
    the least hash stays, and of rows equal in every column one. Null ids come last;
    a component of null ids alone keeps one row too.
    """
    flags = [F.col(c).isNull() for c in docs.columns]
    first, second = free_name(docs, "row_hash"), free_name(docs, "row_hash_too")
    hashed = docs.withColumns({first: F.xxhash64(F.lit(1), *docs.columns, *flags),
                               second: F.xxhash64(F.lit(2), *docs.columns, *flags)})
    texts = hashed.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(first).alias("h1"),
                          F.col(second).alias("h2"))
    rows = materialise(with_fingerprint(texts, "fp", "text", shingle).select("id", "fp", "h1", "h2"), "simhash-rows")
    roots = materialise(_rooted(rows, distance, DENSE).select("fp", "root"), "simhash-roots")
    best = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h1", "h2")).alias("best")
    stays = materialise(rows.join(roots, "fp").groupBy("root").agg(best)
                        .select(F.col("best.h1").alias("s1"), F.col("best.h2").alias("s2")).distinct(), "simhash-keep")
    kept = hashed.join(stays, (F.col(first) == F.col("s1")) & (F.col(second) == F.col("s2")), "left_semi")
    return kept.dropDuplicates([first, second]).select(*docs.columns)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every row of ``documents``."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select(
        F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
