"""URL rules by a blocked Bloom filter and an exact hash join.

A rule is a canonical host and path prefix with a verdict. A url's candidate
keys are its host and every parent domain, each with the path prefixes whose
length some rule has. The keys are looked up in a blocked Bloom filter of the
listed rules: a key's hash picks one block of eight 64-bit words and one bit in
every word, so a lookup touches one block. Possible hits go to an exact join
with the rules, which removes false positives; of the rules that remain for a
url the longest wins (then the longer host, then the smaller rule text).

The filter is a table of blocks joined by block number. It and the rules are
written before use, so Spark broadcasts them only when their measured size is
under the session's threshold, and shuffles otherwise. Distinct (host, path)
pairs are judged once, however many pages share them.

Defined cases: a null url, or one without ``://``, has empty host and path and no
rule; a path is compared as written; rules repeated with one verdict count once,
with both verdicts the block wins; no rules or no pages give no hits; columns of
the pages named host, path, rule or verdict are replaced, others are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimkiln.llm.common import materialise, read_table

WORDS = 8
BITS_PER_KEY = 16
# (host, path, verdict)
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
DEFAULT_VERDICT = "allow"


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url; both empty without ``://``."""
    has = F.coalesce(url.contains("://"), F.lit(False))
    rest = F.substring(url, F.locate("://", url) + 3, F.length(url))
    host = lower_ascii(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.when(has, host).otherwise(""), F.when(has, path).otherwise("")


def _key(host: Column, path: Column) -> Column:
    return F.concat(host, F.lit("\n"), path)


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("block")), F.lit(blocks))


def _bits(key: Column) -> list[Column]:
    """One bit for each word of a block."""
    h = F.xxhash64(key, F.lit("bits"))
    one = F.lit(1).cast("long")
    return [F.call_function("shiftleft", one, F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
            for i in range(WORDS)]


def bloom_blocks(keys: DataFrame, n_keys: int) -> tuple[DataFrame, int]:
    """(block, w0 .. w7) of the column ``key``, and the number of blocks.

    At BITS_PER_KEY bits a key; a partial OR-aggregate per block.
    """
    blocks = max(1, -(-n_keys * BITS_PER_KEY // (64 * WORDS)))
    words = _bits(F.col("key"))
    table = (keys.select(_block(F.col("key"), blocks).alias("block"), *[w.alias(f"w{i}") for i, w in enumerate(words)])
             .groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)]))
    return materialise(table, "url-bloom"), blocks


def possible_hits(keys: DataFrame, bloom: DataFrame, blocks: int) -> DataFrame:
    """Rows of ``keys`` whose ``key`` the filter does not rule out."""
    block = _block(F.col("key"), blocks)
    tagged = keys.withColumn("block", block)
    inside = F.lit(True)
    for i, bit in enumerate(_bits(F.col("key"))):
        inside = inside & (F.col(f"w{i}").bitwiseAND(bit) == bit)
    return tagged.join(bloom, "block").filter(inside).drop("block", *[f"w{i}" for i in range(WORDS)])


def candidate_keys(places: DataFrame, lengths: list[int]) -> DataFrame:
    """(host, path, key): every parent domain with every path prefix of a rule's length."""
    labels = F.split("host", r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)),
                          lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("path"))
    return (places.filter(F.col("host") != "")
            .select("host", "path", F.explode(parents).alias("parent"))
            .select("host", "path", "parent", F.explode(prefixes).alias("n"))
            .select("host", "path", _key(F.col("parent"), F.col("path").substr(F.lit(1), F.col("n"))).alias("key")))


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url",
               default: str = DEFAULT_VERDICT) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has host, path and verdict. The path lengths in use are gathered
    to the driver: one number for each distinct length.
    """
    listed = (rules.select(lower_ascii(F.col("host")).alias("rule_host"), F.col("path").alias("rule_path"), "verdict")
              .filter(F.col("rule_host").isNotNull() & F.col("rule_path").isNotNull())
              .groupBy("rule_host", "rule_path").agg(F.max("verdict").alias("verdict"))
              .withColumn("key", _key(F.col("rule_host"), F.col("rule_path"))))
    listed = materialise(listed, "url-rules")
    n_rules = listed.count()
    lengths = sorted(r[0] for r in listed.select(F.length("rule_path")).distinct().collect())
    host, path = split_url(F.col(url_col))
    judged = (pages.withColumns({"url_host": host, "url_path": path}).drop("host", "path", "rule", "verdict")
              .withColumnsRenamed({"url_host": "host", "url_path": "path"}))
    if not n_rules:
        return judged.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(default))
    bloom, blocks = bloom_blocks(listed, n_rules)
    places = judged.select("host", "path").distinct()
    hits = possible_hits(candidate_keys(places, lengths), bloom, blocks)
    rule = F.concat("rule_host", "rule_path")
    rank = F.struct(F.length(rule).alias("n"), F.length("rule_host").alias("h"))
    best = (hits.join(listed, "key")
            .groupBy("host", "path")
            .agg(F.max_by(F.struct(rule.alias("rule"), F.col("verdict").alias("verdict")),
                          F.struct(rank.alias("rank"), rule.alias("text"))).alias("best")))
    best = materialise(best.select("host", "path", "best.rule", "best.verdict"), "url-verdicts")
    # one row per distinct place: it grows with the pages, so it is never broadcast
    return (judged.join(best.hint("merge"), ["host", "path"], "left")
            .withColumn("verdict", F.coalesce("verdict", F.lit(default))))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the url of every row of ``pages``."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def _rules_sql() -> str:
    return ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)


OP3_SQL = f"""
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {_rules_sql()}),
parts AS (
  SELECT page_id, url, coalesce(contains(url, '://'), false) AS has,
         substr(url, strpos(url, '://') + 3) AS rest FROM pages
), places AS (
  SELECT page_id, row_number() OVER () AS n,
         CASE WHEN has THEN translate(regexp_extract(rest, '^([^/?#]*)', 1),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
         CASE WHEN has THEN regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path FROM parts
)
SELECT page_id, host, path, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
       coalesce(max_by(rule_verdict, length(rule_host || rule_path)), '{DEFAULT_VERDICT}') AS verdict
FROM places LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
GROUP BY n, page_id, host, path
"""
