"""Dimension merges: SCD Type 1 (M-01) and Type 2 (M-02), one pass each.

The stepwise form (update, expire, insert, soft-delete, reactivate, each a
separate statement re-joining dimension and staging) is rewritten into two
joins that Catalyst plans once:

* ``kept``: every dimension row, ``LEFT OUTER JOIN`` staging on the natural
  key, with action flags computed from the pair;
* ``inserts``: staging ``LEFT ANTI JOIN`` the dimension rows that block an
  insert, numbered by ``assign_sk``.

Both joins keep the dimension (the large, possibly skewed side) as the
streamed left side or not at all, so AQE may split a hot key's partition.
The anti join shuffles only key (and type-2) columns of the dimension; its
result, usually small, is numbered and checkpointed in its own job, and the
final job unions it with ``kept``. Staging keys are unique (the staging
primary key; duplicates go to rejects first).

Flag semantics follow §2.6 of the survey: ``u`` type-1 change, ``e`` type-2
expiry, ``x`` soft delete, ``r`` reactivation, ``n`` insert.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimkiln.functions.predicates import any_changed, keys_equal, text_columns
from dimkiln.operators.keys import assign_sk, sk_start as existing_max_sk
from dimkiln.spec import (EFFECTIVE, EXPIRY, INSERTED, IS_CURRENT, IS_DELETED, REASON,
                          REASON_DELETED, REASON_NEW, REASON_REACTIVATED, UPDATED,
                          DimensionSpec)

O = "_o_"          # prefix of staging columns after the join
HIT = "_o_hit"     # marker: staging row matched
FLAGS = ("_u", "_e", "_x", "_r", "_n")

COUNT_COLUMNS = ("Inserted_Count", "Updated_Count", "Deleted_Count",
                 "Reactivated_Count", "Expired_Count")


def ts_literal(run_ts: str) -> Column:
    """Run timestamp as a naive timestamp literal; a parameter, never the clock."""
    return F.lit(run_ts).cast("timestamp_ntz")


@dataclass
class MergeResult:
    """Outcome of a merge: the new dimension plus per-row action flags."""

    spec: DimensionSpec
    kept: DataFrame       # dimension rows after update/expire/delete/reactivate (+ flags)
    inserts: DataFrame    # new rows and new versions, SK assigned (+ flags)

    @property
    def rows(self) -> DataFrame:
        """The whole merged dimension, flags dropped."""
        return self.kept.drop(*FLAGS).unionByName(self.inserts.drop(*FLAGS))

    @property
    def flagged(self) -> DataFrame:
        return self.kept.unionByName(self.inserts)

    def counts(self) -> DataFrame:
        """M-05: one row of action counts, expired included (decision D-7)."""
        return self.flagged.agg(*merge_count_columns())

    def action_rows(self, flag: str) -> DataFrame:
        return self.flagged.filter(F.col(flag)).drop(*FLAGS)


def merge_count_columns() -> list[Column]:
    return [F.count_if(F.col("_n")).alias("Inserted_Count"),
            F.count_if(F.col("_u")).alias("Updated_Count"),
            F.count_if(F.col("_x")).alias("Deleted_Count"),
            F.count_if(F.col("_r")).alias("Reactivated_Count"),
            F.count_if(F.col("_e")).alias("Expired_Count")]


def _staging_side(stg: DataFrame, spec: DimensionSpec) -> DataFrame:
    return stg.select(*[F.col(c).alias(O + c) for c in spec.columns], F.lit(True).alias(HIT))


def _join_cond(spec: DimensionSpec, schema=None) -> Column:
    text = text_columns(schema) if (schema is not None and spec.collation) else set()
    return keys_equal(spec.keys, [O + k for k in spec.keys], text, spec.collation)


def _with_new_sk(new_rows: DataFrame, dim: DataFrame, spec: DimensionSpec,
                 start: int | None) -> DataFrame:
    first = existing_max_sk(dim, spec.sk) if start is None else start
    return assign_sk(new_rows, list(spec.keys), spec.sk, start=first)


def _insert_rows(candidates: DataFrame, spec: DimensionSpec, run_ts: str) -> DataFrame:
    ts = ts_literal(run_ts)
    cols = [F.col(O + c).alias(c) for c in spec.columns]
    audit = [ts.alias(INSERTED), F.lit(None).cast("timestamp_ntz").alias(UPDATED),
             F.lit(0).alias(IS_DELETED), F.lit(REASON_NEW).alias(REASON)]
    if spec.is_scd2:
        audit += [F.lit(1).alias(IS_CURRENT), ts.alias(EFFECTIVE),
                  F.lit(None).cast("timestamp_ntz").alias(EXPIRY)]
    flags = [F.lit(f == "_n").alias(f) for f in FLAGS]
    return candidates.select(*cols, *audit, *flags)


def _conform(inserts: DataFrame, dim: DataFrame) -> DataFrame:
    """Inserts in the dimension's column order; columns the spec does not map
    (kept from an earlier layout) are typed NULLs."""
    cols = [F.col(c) if c in inserts.columns else F.lit(None).cast(dim.schema[c].dataType).alias(c)
            for c in dim.columns]
    return inserts.select(*cols, *FLAGS)


def scd1_merge(dim: DataFrame, stg: DataFrame, spec: DimensionSpec, run_ts: str,
               soft_delete: bool = True, sk_start: int | None = None) -> MergeResult:
    """M-01 (and M-03 with ``soft_delete=False``): Type 1 merge in one pass.

    ``u``: matched and a type-1 column differs -> overwrite, Updated=run_ts,
    reason unchanged. ``x``: not in staging and active -> Is_Deleted=1.
    ``r``: matched and deleted -> Is_Deleted=0. ``n``: staging key absent
    from the dimension (any row, deleted or not) -> inserted.
    """
    if spec.is_scd2:
        raise ValueError(f"{spec.name} has type 2 columns; use scd2_merge")
    ts = ts_literal(run_ts)
    o = _staging_side(stg, spec)
    j = dim.join(o, _join_cond(spec, dim.schema), "left_outer")
    hit = F.col(HIT).isNotNull()
    u = hit & any_changed(spec.type1, stg.schema, "", O, spec.collation)
    x = (~hit & (F.col(IS_DELETED) == 0)) if soft_delete else F.lit(False)
    r = hit & (F.col(IS_DELETED) == 1)
    j = j.withColumns({"_u": u, "_x": x, "_r": r})
    u, x, r = F.col("_u"), F.col("_x"), F.col("_r")
    updates = {c: F.when(u, F.col(O + c)).otherwise(F.col(c)) for c in spec.type1}
    updates.update({
        UPDATED: F.when(u | x | r, ts).otherwise(F.col(UPDATED)),
        IS_DELETED: F.when(x, F.lit(1)).when(r, F.lit(0)).otherwise(F.col(IS_DELETED)),
        REASON: F.when(x, F.lit(REASON_DELETED)).when(r, F.lit(REASON_REACTIVATED))
                 .otherwise(F.col(REASON)),
        "_e": F.lit(False), "_n": F.lit(False),
    })
    kept = j.withColumns(updates).select(*dim.columns, *FLAGS)

    # NOT EXISTS over the whole dimension: only key columns are shuffled.
    candidates = o.join(dim.select(*spec.keys), _join_cond(spec, dim.schema), "left_anti")
    inserts = _with_new_sk(_insert_rows(candidates, spec, run_ts), dim, spec, sk_start)
    return MergeResult(spec, kept, _conform(inserts, dim))


def scd2_merge(dim: DataFrame, stg: DataFrame, spec: DimensionSpec, run_ts: str,
               close_on_delete: bool = False, strict_current: bool = False,
               soft_delete: bool = True, sk_start: int | None = None) -> MergeResult:
    """M-02 (M-04 with ``close_on_delete=True``): Type 2 merge in one pass.

    Over all versions of ``dim LEFT JOIN stg``: ``u`` type-1 change on any
    version; ``e`` current version whose type-2 columns differ -> expired;
    ``x`` current, active, key gone -> deleted, expiry set, still current
    (closed too with ``close_on_delete``); ``r`` any deleted version whose
    key is back -> reactivated, expiry kept (``strict_current`` limits it to
    the current version and clears expiry, decision D-13).
    Inserts: staging rows with no current version left after expiry.
    """
    if not spec.is_scd2:
        raise ValueError(f"{spec.name} has no type 2 columns; use scd1_merge")
    ts = ts_literal(run_ts)
    o = _staging_side(stg, spec)
    j = dim.join(o, _join_cond(spec, dim.schema), "left_outer")
    hit = F.col(HIT).isNotNull()
    current = F.col(IS_CURRENT) == 1
    u = hit & any_changed(spec.type1, stg.schema, "", O, spec.collation)
    e = hit & current & any_changed(spec.type2, stg.schema, "", O, spec.collation)
    x = (~hit & current & (F.col(IS_DELETED) == 0)) if soft_delete else F.lit(False)
    r = hit & (F.col(IS_DELETED) == 1)
    if strict_current:
        r = r & current
    j = j.withColumns({"_u": u, "_e": e, "_x": x, "_r": r})
    u, e, x, r = F.col("_u"), F.col("_e"), F.col("_x"), F.col("_r")
    closes = (e | x) if close_on_delete else e
    expiry = F.when(e | x, ts)
    if strict_current:
        expiry = expiry.when(r, F.lit(None).cast("timestamp_ntz"))
    updates = {c: F.when(u, F.col(O + c)).otherwise(F.col(c)) for c in spec.type1}
    updates.update({
        IS_CURRENT: F.when(closes, F.lit(0)).otherwise(F.col(IS_CURRENT)),
        EXPIRY: expiry.otherwise(F.col(EXPIRY)),
        UPDATED: F.when(u | e | x | r, ts).otherwise(F.col(UPDATED)),
        IS_DELETED: F.when(x, F.lit(1)).when(r, F.lit(0)).otherwise(F.col(IS_DELETED)),
        REASON: F.when(x, F.lit(REASON_DELETED)).when(r, F.lit(REASON_REACTIVATED))
                 .otherwise(F.col(REASON)),
        "_n": F.lit(False),
    })
    kept = j.withColumns(updates).select(*dim.columns, *FLAGS)

    # A staging row is blocked by a current version with equal type-2 values
    # (that version survives the expiry step); only keys and type-2 columns of
    # current rows are shuffled for this anti join.
    blocking = dim.filter(current).select(*spec.keys, *spec.type2)
    cond = _join_cond(spec, dim.schema) & ~any_changed(spec.type2, stg.schema, "", O, spec.collation)
    candidates = o.join(blocking, cond, "left_anti")
    inserts = _with_new_sk(_insert_rows(candidates, spec, run_ts), dim, spec, sk_start)
    return MergeResult(spec, kept, _conform(inserts, dim))


def merge(dim: DataFrame, stg: DataFrame, spec: DimensionSpec, run_ts: str, **kw) -> MergeResult:
    """Dispatch on the spec: its own ``merge`` callable, else SCD2 or SCD1."""
    if spec.merge is not None:
        return spec.merge(dim, stg, run_ts)
    return (scd2_merge if spec.is_scd2 else scd1_merge)(dim, stg, spec, run_ts, **kw)


# --- the single steps as standalone operators (J-01..J-04, F-05) ----------

def new_rows(dim: DataFrame, stg: DataFrame, keys: Iterable[str]) -> DataFrame:
    """J-02: staging rows whose key has no dimension row (NOT EXISTS)."""
    return stg.join(dim.select(*keys), list(keys), "left_anti")


def missing_rows(dim: DataFrame, stg: DataFrame, keys: Iterable[str]) -> DataFrame:
    """J-03: dimension rows whose key is gone from staging (anti join, not left join + IS NULL)."""
    return dim.join(stg.select(*keys), list(keys), "left_anti")


def reappeared_rows(dim: DataFrame, stg: DataFrame, keys: Iterable[str]) -> DataFrame:
    """J-04: deleted dimension rows whose key is back in staging."""
    return dim.filter(F.col(IS_DELETED) == 1).join(stg.select(*keys), list(keys), "left_semi")


def changed_rows(dim: DataFrame, stg: DataFrame, spec: DimensionSpec,
                 columns: Iterable[str] | None = None) -> DataFrame:
    """J-01 + F-04: matched pairs where any of ``columns`` (default type 1) differs.

    Returns the dimension row's key and SK with the old and new values.
    """
    cols = list(spec.type1 if columns is None else columns)
    o = _staging_side(stg, spec)
    j = dim.join(o, _join_cond(spec, dim.schema), "inner").filter(
        any_changed(cols, stg.schema, "", O, spec.collation))
    return j.select(spec.sk, *spec.keys, *[F.col(c).alias(f"old_{c}") for c in cols],
                    *[F.col(O + c).alias(f"new_{c}") for c in cols])


def current_rows(dim: DataFrame, scd2: bool = True) -> DataFrame:
    """F-05: active rows: not deleted and, for Type 2, current."""
    cond = F.col(IS_DELETED) == 0
    if scd2:
        cond = cond & (F.col(IS_CURRENT) == 1)
    return dim.filter(cond)
