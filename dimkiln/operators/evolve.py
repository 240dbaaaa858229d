"""Dimension rebuild and schema evolution (M-06, M-07, M-11, O-03).

A rebuild is a projection of the old snapshot into the new layout, written
as a new snapshot (the old one stays as the backup); surrogate keys pass
through unchanged. Columns the old snapshot lacks become typed NULLs
(decision D-5); the Type 2 defaults apply only when a Type 1 table is
promoted to Type 2.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimkiln.functions.types import parse_declared
from dimkiln.session import write_shared
from dimkiln.spec import (EFFECTIVE, EXPIRY, INSERTED, IS_CURRENT, IS_DELETED, REASON,
                          UPDATED, DimensionSpec)

_AUDIT_TYPES = {INSERTED: "timestamp_ntz", UPDATED: "timestamp_ntz", IS_DELETED: "int",
                REASON: "string", IS_CURRENT: "int", EFFECTIVE: "timestamp_ntz",
                EXPIRY: "timestamp_ntz"}


def layout(spec: DimensionSpec) -> list[tuple[str, str]]:
    """(column, Spark type) of the dimension table of ``spec``."""
    cols = [(spec.sk, "bigint")]
    cols += [(c, parse_declared(spec.types[c]).spark_type if c in spec.types else None)
             for c in spec.columns]
    cols += [(c, _AUDIT_TYPES[c]) for c in spec.audit_columns()]
    return cols


def rebuild_dimension(old: DataFrame, spec: DimensionSpec, run_ts: str) -> DataFrame:
    """M-06 + M-11: the old rows in the new layout, SKs kept.

    Values are converted with ``try_cast`` (a value that no longer fits is
    NULL). Promotion to Type 2 sets current, effective = run_ts, no expiry.
    """
    have = set(old.columns)
    promote = spec.is_scd2 and IS_CURRENT not in have
    ts = F.lit(run_ts).cast("timestamp_ntz")
    defaults = {IS_CURRENT: F.lit(1), EFFECTIVE: ts, EXPIRY: F.lit(None).cast("timestamp_ntz"),
                IS_DELETED: F.lit(0)}
    out = []
    for name, typ in layout(spec):
        if name in have:
            c = F.col(name)
            if typ is not None and old.schema[name].dataType.simpleString() != typ:
                c = c.try_cast(typ)
        elif promote and name in defaults or name == IS_DELETED:
            c = defaults[name]
        else:
            c = F.lit(None)
            if typ is not None:
                c = c.cast(typ)
        out.append(c.alias(name))
    return old.select(*out)


def split_rebuild(old: DataFrame, spec: DimensionSpec, run_ts: str) -> tuple[DataFrame, DataFrame]:
    """M-06: (the rebuilt rows, the old rows that do not fit the new layout).

    A row with a value that cannot be converted is not carried over with a
    NULL in its place: it becomes a reject row with its reason and its old
    values as JSON. On demotion from Type 2 each key keeps one version: the
    current one, or the one last in effect when none is current.

    Other key columns may put several active rows under one key, which the
    constraint on active keys forbids (M-08): the one changed last stays (of
    those the smallest SK), the others become reject rows that name its SK. A
    row without a value in a new key column is a reject too. Expired and
    deleted rows are history and stay. Only keys and SKs are grouped, with a
    partial aggregate; the keys held more than once are joined back to the rows.
    """
    have = set(old.columns)
    if IS_CURRENT in have and not spec.is_scd2:
        keys = [k for k in spec.keys if k in have]
        latest = F.struct(F.col(IS_CURRENT), F.col(EFFECTIVE), *([spec.sk] if spec.sk in have else []))
        old = (old.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
               .agg(F.max_by(F.struct(*old.columns), latest).alias("_row")).select("_row.*"))
    failed = []
    for name, typ in layout(spec):
        if name in have and typ is not None and old.schema[name].dataType.simpleString() != typ:
            bad = F.col(name).isNotNull() & F.col(name).try_cast(typ).isNull()
            failed.append(F.when(bad, F.concat(F.lit(f"TYPE_ERROR: {name}='"), F.col(name).cast("string"),
                                               F.lit(f"' is not {typ.upper()}"))))
    failed += [F.when(F.col(k).isNull(), F.lit(f"NULL_KEY: {k}")) for k in spec.keys if k in have]
    reason = F.concat_ws("; ", *failed) if failed else F.lit("")
    fit = rebuild_dimension(old.filter(reason == ""), spec, run_ts)
    as_json = F.to_json(F.struct(*old.columns), {"ignoreNullFields": "false"})
    unfit = old.filter(reason != "").select(reason.alias("Rejected_Reason"), as_json.alias("Raw_Data"))
    if spec.sk not in have or IS_DELETED not in have or set(spec.keys) - have:
        return fit, unfit

    crowded = _crowded_keys(fit, spec)
    same = reduce(lambda a, b: a & b, [
        _binary(F.col(k), fit, k, spec.collation) == F.col(f"_rk_{k}") for k in spec.keys])
    marked = fit.join(crowded, same, "left")
    extra = F.coalesce(_active(spec) & (F.col("_kept_sk") != F.col(spec.sk)), F.lit(False))
    kept = marked.filter(~extra).select(*fit.columns)
    out = marked.filter(extra).select(F.col(spec.sk).alias("_out_sk"), "_kept_sk",
                                      *[F.col(k).cast("string").alias(f"_out_{k}") for k in spec.keys])
    named = F.concat_ws(", ", *[F.concat(F.lit(f"{k}="), F.col(f"_out_{k}")) for k in spec.keys])
    moved = old.join(out, F.col(spec.sk) == F.col("_out_sk")).select(
        F.concat(F.lit("DUPLICATE_KEY: "), named, F.lit(" stays with SK "), F.col("_kept_sk").cast("string"))
        .alias("Rejected_Reason"), as_json.alias("Raw_Data"))
    return kept, unfit.unionByName(moved)


def _active(spec: DimensionSpec):
    active = F.col(IS_DELETED) == 0
    return active & (F.col(IS_CURRENT) == 1) if spec.is_scd2 else active


def _binary(col, df: DataFrame, name: str, collation: str | None):
    text = df.schema[name].dataType.typeName() in ("string", "varchar", "char")
    return F.collate(col, collation) if collation and text else col


def _crowded_keys(rows: DataFrame, spec: DimensionSpec) -> DataFrame:
    """(``_rk_`` keys, ``_kept_sk``) of keys with more than one active row, written once."""
    changed = F.coalesce(F.col(UPDATED), F.col(INSERTED)) if {UPDATED, INSERTED} <= set(rows.columns) else F.lit(None)
    best = F.max(F.struct(changed.cast("timestamp_ntz").alias("at"), (-F.col(spec.sk)).alias("sk"))).alias("best")
    found = (rows.filter(_active(spec))
             .groupBy(*[_binary(F.col(k), rows, k, spec.collation).alias(f"_rk_{k}") for k in spec.keys])
             .agg(F.count(F.lit(1)).alias("n"), best).filter("n > 1"))
    plain = [F.collate(F.col(f"_rk_{k}"), "UTF8_BINARY").alias(f"_rk_{k}")
             if rows.schema[k].dataType.typeName() in ("string", "varchar", "char") else F.col(f"_rk_{k}") for k in spec.keys]
    return write_shared(found.select(*plain, (-F.col("best.sk")).alias("_kept_sk")), "crowded-keys")


def evolve_schema(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """M-07: add the columns the frame lacks (typed NULL), keep the rest as is."""
    missing = {n: F.lit(None).cast(t) for n, t in columns.items() if n not in df.columns}
    return df.withColumns(missing) if missing else df


def union_distinct(frames: Iterable[DataFrame]) -> DataFrame:
    """O-03: all files stacked by column name, then whole-row distinct.

    ``distinct`` aggregates partially in every map task before the shuffle.
    """
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), list(frames)).distinct()
