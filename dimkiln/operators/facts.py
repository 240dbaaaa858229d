"""Fact operators (X-01..X-06), planned by the reference and built here.

Facts are the large side of every join: they stay the streamed (left) side
so that AQE can split a partition made big by a hot dimension key, and the
dimension is broadcast only when its measured size is under the threshold.
Measures are summed as decimals so totals are exact and order-independent.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimkiln.spec import IS_CURRENT

# Reject reason prefixes of fact loads.
MISSING_FK = "MISSING_FK"
INVALID_MEASURE = "INVALID_MEASURE"


def current_keys(dim: DataFrame, keys: Sequence[str], sk_col: str, scd2: bool) -> DataFrame:
    """Natural key -> SK of the current version (one row per key)."""
    d = dim.filter(F.col(IS_CURRENT) == 1) if scd2 else dim
    return d.select(*keys, sk_col)


def lookup_keys(fact: DataFrame, dim_keys: DataFrame, fact_keys: Sequence[str],
                dim_key_names: Sequence[str], sk_col: str) -> DataFrame:
    """X-01: add the dimension SK to every fact row (NULL when the key is unknown)."""
    d = dim_keys.select(*[F.col(k).alias(f"_fk_{k}") for k in dim_key_names], sk_col)
    on = reduce(lambda a, b: a & b,
                [F.col(f) == F.col(f"_fk_{k}") for f, k in zip(fact_keys, dim_key_names)])
    return fact.join(d, on, "left").drop(*[f"_fk_{k}" for k in dim_key_names])


def split_missing(looked_up: DataFrame, sk_col: str, fact_keys: Sequence[str],
                  dim_name: str) -> tuple[DataFrame, DataFrame]:
    """X-01: (rows with an SK, rows without one plus a reject reason)."""
    found = looked_up.filter(F.col(sk_col).isNotNull())
    reason = F.concat(F.lit(f"{MISSING_FK}: {dim_name} "),
                      F.concat_ws(", ", *[F.concat(F.lit(f"{k}="), F.coalesce(F.col(k).cast("string"),
                                                                              F.lit("NULL")))
                                          for k in fact_keys]))
    missing = looked_up.filter(F.col(sk_col).isNull()).drop(sk_col) \
        .withColumn("Rejected_Reason", reason)
    return found, missing


def _sum(df: DataFrame, src: str, scale: int) -> Column:
    """The exact sum of a measure, rounded to ``scale`` once, after adding.

    Decimals and integers add as they are. Binary floats are first written
    out as decimals with twelve places, where their sums do not depend on the
    order of rows.
    """
    kind = df.schema[src].dataType.typeName()
    value = F.col(src).cast("decimal(28,12)") if kind in ("float", "double", "string") else F.col(src)
    return F.round(F.sum(value), scale).cast(f"decimal(38,{scale})")


def aggregate(fact: DataFrame, grain: Sequence[str | Column], measures: Mapping[str, str],
              count_col: str | None = "Row_Count", scale: int = 2) -> DataFrame:
    """X-02: SUM of each measure (as decimal) and a row count at the grain.

    ``measures`` maps output name -> input column; ``scale`` is that of the
    result, rows are not rounded. Partial aggregation runs map-side, so a hot
    grain key is reduced before the shuffle.
    """
    aggs = [_sum(fact, src, scale).alias(out) for out, src in measures.items()]
    if count_col:
        aggs.append(F.count(F.lit(1)).alias(count_col))
    return fact.groupBy(*grain).agg(*aggs)


def incremental(fact: DataFrame, ts_col: str, high_water_mark: str) -> DataFrame:
    """X-03: rows above a stored high-water mark; the filter reaches the scan."""
    return fact.filter(F.col(ts_col) > F.lit(high_water_mark).cast("timestamp_ntz"))


def next_high_water_mark(rows: DataFrame, ts_col: str) -> DataFrame:
    """X-03: the mark to store after a load (one row)."""
    return rows.agg(F.max(ts_col).alias("High_Water_Mark"))


def measure_rules(rules: Mapping[str, Column]) -> Column:
    """Reason text listing every failed rule (NULL when all hold)."""
    parts = [F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]
    text = F.concat_ws(", ", *parts)
    return F.when(text == "", F.lit(None)).otherwise(F.concat(F.lit(f"{INVALID_MEASURE}: "), text))


def split_invalid(fact: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """X-06: (valid rows, invalid rows with ``Rejected_Reason``) from one predicate."""
    r = fact.withColumn("Rejected_Reason", measure_rules(rules))
    return (r.filter(F.col("Rejected_Reason").isNull()).drop("Rejected_Reason"),
            r.filter(F.col("Rejected_Reason").isNotNull()))


def measure_totals(fact: DataFrame, measures: Mapping[str, str], scale: int = 2) -> DataFrame:
    """X-06 audit: totals of each measure and the row count (one row)."""
    return aggregate(fact, [], measures, "Row_Count", scale)


def fact_merge(existing: DataFrame, incoming: DataFrame, grain: Sequence[str],
               measures: Iterable[str], run_ts: str) -> DataFrame:
    """X-05: insert new grain keys, update measures of existing ones (no deletes).

    ``existing LEFT JOIN incoming`` for kept rows + ``incoming LEFT ANTI
    existing`` for inserts, as the Type 1 merge without soft delete.
    ``Action`` is ``insert``, ``update`` or ``keep``.
    """
    measures = list(measures)
    ts = F.lit(run_ts).cast("timestamp_ntz")
    inc = incoming.select(*[F.col(c).alias(f"_n_{c}") for c in grain + measures],
                          F.lit(True).alias("_hit"))
    on = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_n_{g}")) for g in grain])
    j = existing.join(inc, on, "left")
    changed = reduce(lambda a, b: a | b, [~F.col(m).eqNullSafe(F.col(f"_n_{m}")) for m in measures])
    upd = F.col("_hit").isNotNull() & changed
    kept = j.select(*grain, *[F.when(upd, F.col(f"_n_{m}")).otherwise(F.col(m)).alias(m)
                              for m in measures],
                    F.col("Inserted_Datetime"),
                    F.when(upd, ts).otherwise(F.col("Updated_Datetime")).alias("Updated_Datetime"),
                    F.when(upd, F.lit("update")).otherwise(F.lit("keep")).alias("Action"))
    on_anti = reduce(lambda a, b: a & b, [F.col(f"_n_{g}").eqNullSafe(F.col(g)) for g in grain])
    new = inc.join(existing.select(*grain), on_anti, "left_anti").select(
        *[F.col(f"_n_{c}").alias(c) for c in grain + measures], ts.alias("Inserted_Datetime"),
        F.lit(None).cast("timestamp_ntz").alias("Updated_Datetime"), F.lit("insert").alias("Action"))
    return kept.unionByName(new)


# --- stored sums that increments are added to (X-02 with X-05) ---------------

STATE_KEY = "State_Key"
ROWS = "State_Rows"


def fact_states(fact: DataFrame, grain: Sequence[str], measures: Mapping[str, str],
                sign: Column | None = None) -> DataFrame:
    """X-02: per grain the unrounded sums of the measures and the rows behind them.

    ``sign`` is 1 for a row that arrives and -1 for one that is taken back;
    states of any number of increments add up to the state of all their rows.
    ``State_Key`` is the grain as text, the key they are stored under.
    """
    one = F.lit(1) if sign is None else sign
    sums = [F.sum((F.col(src).cast("decimal(28,12)") * one.cast("decimal(1,0)")).cast("decimal(28,12)"))
            .cast("decimal(38,12)").alias(out) for out, src in measures.items()]
    state = fact.groupBy(*grain).agg(*sums, F.sum(one.cast("long")).alias(ROWS))
    return state.withColumn(STATE_KEY, F.to_json(F.struct(*grain), {"ignoreNullFields": "false"}))


def add_states(stored: DataFrame, arriving: DataFrame, grain: Sequence[str], measures: Iterable[str]) -> DataFrame:
    """X-05: the new states of the grains that ``arriving`` touches; no others.

    The stored side is joined by key, so only its touched rows come back. A grain
    whose rows were all taken back stays with no rows, until ``finished`` leaves it out.
    """
    names = list(measures)
    old = stored.select(STATE_KEY, *[F.col(m).alias(f"_s_{m}") for m in (*names, ROWS)])
    both = arriving.join(old, STATE_KEY, "left")
    return both.select(*grain, *[(F.col(m) + F.coalesce(f"_s_{m}", F.lit(0))).cast(arriving.schema[m].dataType).alias(m)
                                 for m in (*names, ROWS)], STATE_KEY)


def finished(states: DataFrame, grain: Sequence[str], measures: Iterable[str], scale: int = 2) -> DataFrame:
    """X-02: the aggregate that the states stand for, rounded once."""
    return states.filter(F.col(ROWS) != 0).select(
        *grain, *[F.round(F.col(m), scale).cast(f"decimal(38,{scale})").alias(m) for m in measures],
        F.col(ROWS).alias("Row_Count"))
