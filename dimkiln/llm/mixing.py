"""Mixing sources to target weights by Poisson replication (native).

Every source gets a mean repetition rate: its share of the target size over its
own size, both in characters over all documents. Each document draws a count
from a Poisson distribution of that mean by inverting the distribution function
at a uniform number hashed from (seed, id, text); it is emitted that many times,
and all copies are shuffled globally: each goes to a partition and to a place in
it by a hash of (seed, id, text, copy). Everything is a function of seed and row,
so a lost task is redone with the same draws.

The inversion is a count over a short table of cumulative probabilities. A mean
of BLOCK or more is cut into means of BLOCK and a rest, each drawn with a hash of
its own, as sums of Poisson draws are Poisson again; so no mean is too large.

Defined cases: a null text has no characters and a null source is a source of its
own; a source of no characters, or with weight 0 or none, has rate 0 and gives no
copies; rows equal in id and text draw equal counts; an empty table gives an
empty result; the input may have columns of any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimkiln.llm.common import free_name, materialise, read_table, text_of

SEED = 7
BLOCK = 16
# the chance of a draw beyond TERMS at mean BLOCK is below the spacing of the uniforms
TERMS = 64
TEMPERATURE = 0.7


def uniform(key: Column) -> Column:
    """A number in [0, 1) with 52 random bits, from the MD5 of a text."""
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def cumulative(mean: Column) -> Column:
    """P(X <= 0), ..., P(X <= TERMS) of a Poisson variable."""
    first = F.exp(-mean)
    zero = F.struct(first.alias("p"), F.array(first).alias("c"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(TERMS)), zero,
        lambda a, k: F.struct(
            (a["p"] * mean / k).alias("p"),
            F.concat(a["c"], F.array(F.element_at(a["c"], -1) + a["p"] * mean / k)).alias("c")),
        lambda a: a["c"])


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, target_chars: float | None = None,
                 source_col: str = "source", text_col: str = "text",
                 temperature: float = TEMPERATURE) -> DataFrame:
    """(source, chars, rate) per source, from sums over all documents.

    ``weights`` are the target shares, in any scale; without them a source's
    weight is its size to the power ``temperature``. ``target_chars`` is the
    expected size of the mix, the input's own size if none is given.
    """
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(
        F.sum(F.length(text_of(text_col))).cast("double").alias("chars"))
    if weights is None:
        weight = F.when(F.col("chars") > 0, F.pow("chars", F.lit(temperature))).otherwise(0.0)
    else:
        spark = docs.sparkSession
        table = spark.createDataFrame(list(weights.items()), "source string, weight double")
        sizes = (sizes.alias("s").join(table.alias("w"), F.col("s.source").eqNullSafe(F.col("w.source")), "left")
                 .select("s.source", "chars", "weight"))
        weight = F.when(F.col("chars") > 0, F.coalesce("weight", F.lit(0.0))).otherwise(0.0)
    weighed = materialise(sizes.select("source", "chars", weight.alias("weight")), "mix-sizes")
    total = weighed.agg(F.sum("weight").alias("w"), F.sum("chars").alias("c"))
    target = F.lit(float(target_chars)) if target_chars is not None else total.select("c").scalar()
    rate = F.when(F.col("weight") > 0, F.col("weight") / total.select("w").scalar() * target / F.col("chars"))
    return weighed.select("source", "chars", F.coalesce(rate, F.lit(0.0)).alias("rate"))


def draw_count(rate: Column, rest: Column, key: Column, seed: int = SEED) -> Column:
    """A Poisson draw of mean ``rate``; ``rest`` is the table of ``rate % BLOCK``."""
    full = F.array(*[F.lit(x) for x in _table(BLOCK)])
    whole = F.floor(rate / BLOCK).cast("int")
    # the uniforms are made before they are compared: inside a comparison with the table, its
    # lambda would hash the key again for every entry
    uniforms = F.transform(F.sequence(F.lit(0), whole), lambda block: uniform(
        F.concat_ws("|", F.lit(seed).cast("string"), block.cast("string"), key)))
    draws = F.transform(uniforms, lambda u, block: F.when(block < whole, _below(full, u)).otherwise(_below(rest, u)))
    return F.aggregate(draws, F.lit(0), lambda total, n: total + n)


def _below(table: Column, u: Column) -> Column:
    return F.size(F.filter(table, lambda c: c <= u))


def _table(mean: float) -> list[float]:
    from math import exp
    p = c = exp(-mean)
    out = [c]
    for k in range(1, TERMS + 1):
        p = p * mean / k
        c += p
        out.append(c)
    return out


def mix(docs: DataFrame, weights: dict[str, float] | None = None, target_chars: float | None = None,
        id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        seed: int = SEED, temperature: float = TEMPERATURE) -> DataFrame:
    """The shuffled mix: all columns of ``docs`` and ``mix_rate``, ``mix_copies``,
    ``mix_copy`` (1 to copies) and ``mix_key`` (its order within a partition).

    The per-source table is written first, so the join broadcasts it only when
    its measured size is under the session's broadcast threshold.
    """
    rates = source_rates(docs, weights, target_chars, source_col, text_col, temperature)
    src, rate, rest, ident = (free_name(docs, n) for n in ("mix_source", "mix_rate", "mix_rest", "mix_ident"))
    table = materialise(rates.select(
        F.col("source").alias(src), F.col("rate").alias(rate),
        cumulative(F.col("rate") - F.floor(F.col("rate") / BLOCK) * BLOCK).alias(rest)), "mix-rates")
    copies, copy, key = (free_name(docs, n) for n in ("mix_copies", "mix_copy", "mix_key"))
    name = F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.sha1(text_of(text_col).cast("binary")))
    drawn = (docs.join(table, docs[source_col].eqNullSafe(table[src]))
             .withColumn(ident, name)
             .withColumn(copies, draw_count(F.col(rate), F.col(rest), F.col(ident), seed))
             # a filter on the count would be pushed below it and draw a second time, with the text's
             # digest; none is inferred from an outer generator, whose null row goes afterwards
             .withColumn(copy, F.explode_outer(F.when(F.col(copies) > 0, F.sequence(F.lit(1), F.col(copies)))))
             .filter(F.col(copy).isNotNull())
             .withColumn(key, F.md5(F.concat_ws("|", F.lit(f"shuffle{seed}"), F.col(ident), F.col(copy).cast("string"))
                                    .cast("binary"))))
    return (drawn.drop(src, rest, ident).repartition(F.col(key)).sortWithinPartitions(key))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all ``documents``: one row per copy, with a digest of its text."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select(
        "doc_id", "source", F.round("mix_rate", 6).alias("rate"), F.col("mix_copies").alias("n_copies"),
        F.col("mix_copy").alias("copy"), F.col("mix_key").alias("shuffle_key"),
        F.sha1(text_of("text").cast("binary")).alias("text_sha1"))


OP4_SQL = f"""
WITH sizes AS (
  SELECT source, sum(length(coalesce(text, '')))::DOUBLE AS chars FROM documents GROUP BY source
), weighed AS (
  SELECT source, chars, CASE WHEN chars > 0 THEN pow(chars, {TEMPERATURE}) ELSE 0 END AS weight FROM sizes
), rates AS (
  SELECT source, CASE WHEN weight > 0 THEN weight / sum(weight) OVER () * sum(chars) OVER () / chars ELSE 0 END AS rate
  FROM weighed
), terms AS (
  SELECT source, rate, floor(rate / {BLOCK})::INT AS whole, k,
         CASE WHEN part = 0 THEN {BLOCK}.0 ELSE rate - floor(rate / {BLOCK}) * {BLOCK} END AS mean, part
  FROM rates, range({TERMS} + 1) AS t(k), (VALUES (0), (1)) AS p(part)
), mass AS (
  SELECT *, CASE WHEN k = 0 THEN exp(-mean) WHEN mean = 0 THEN 0.0
            ELSE exp(k * ln(mean) - mean - lgamma(k + 1)) END AS p FROM terms
), cdf AS (
  SELECT source, rate, whole, part, list(c ORDER BY k) AS c FROM (
    SELECT source, rate, whole, part, k, sum(p) OVER (PARTITION BY source, part ORDER BY k) AS c FROM mass)
  GROUP BY ALL
), draws AS (
  SELECT d.doc_id, d.source, round(f.rate, 6) AS rate, sha1(coalesce(d.text, '')) AS text_sha1,
         d.doc_id::VARCHAR || '|' || sha1(coalesce(d.text, '')) AS ident,
         ('0x' || substr(md5('{SEED}|' || b.b::VARCHAR || '|' || d.doc_id::VARCHAR || '|' || sha1(coalesce(d.text, ''))), 1, 13))::BIGINT
           / 4503599627370496.0 AS u, f.c AS full_c, r.c AS rest_c, b.b, f.whole
  FROM documents d JOIN cdf f ON f.source IS NOT DISTINCT FROM d.source AND f.part = 0
  JOIN cdf r ON r.source IS NOT DISTINCT FROM d.source AND r.part = 1, LATERAL (SELECT unnest(range(f.whole + 1)) AS b) b
), counts AS (
  SELECT doc_id, source, rate, ident, text_sha1,
         sum(len(list_filter(CASE WHEN b < whole THEN full_c ELSE rest_c END, lambda x: x <= u)))::INT AS n
  FROM draws GROUP BY ALL
)
SELECT doc_id, source, rate, n AS n_copies, copy::INT AS copy, text_sha1,
       md5('shuffle{SEED}|' || ident || '|' || copy::VARCHAR) AS shuffle_key
FROM counts, LATERAL (SELECT unnest(range(1, n + 1)) AS copy) c
"""
