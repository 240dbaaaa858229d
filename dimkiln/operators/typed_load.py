"""Typed load with per-row rejection (K-02, M-09, P-08, D-14).

The text frame is converted column by column with ``try_cast``; every failed
rule adds a message, and one pass splits good rows (to the staging table)
from bad rows (to the reject table). Both outputs come from the same scan:
the caller persists the checked frame once and writes twice (``split``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimkiln.functions.types import convert, conversion_error, parse_declared
from dimkiln.spec import DimensionSpec

REASONS = "_reasons"

# Reject reason texts of the typed load.
NULL_KEY = "NULL_KEY"
MISSING_REQUIRED = "MISSING_REQUIRED"
TYPE_ERROR = "TYPE_ERROR"
TOO_LONG = "TOO_LONG"


def _messages(spec: DimensionSpec):
    msgs = []
    for c in spec.columns:
        dt = parse_declared(spec.types.get(c, "VARCHAR(8000)"))
        text = F.col(f"_raw_{c}")
        value = F.col(c)
        blank = text.isNull() | (F.trim(text) == "")
        if c in spec.keys:
            msgs.append(F.when(blank, F.lit(f"{NULL_KEY}: {c}")))
        elif c in spec.required:
            msgs.append(F.when(blank, F.lit(f"{MISSING_REQUIRED}: {c}")))
        if dt.spark_type == "string":
            if dt.max_length is not None:
                msgs.append(F.when(conversion_error(text, value, dt),
                                   F.lit(f"{TOO_LONG}: {c} > {dt.max_length}")))
        else:
            msgs.append(F.when(conversion_error(text, value, dt),
                               F.concat(F.lit(f"{TYPE_ERROR}: {c}='"), text,
                                        F.lit(f"' is not {dt.declared.upper()}"))))
    return msgs


def check_rows(text_df: DataFrame, spec: DimensionSpec) -> DataFrame:
    """Typed values plus ``_reasons`` (NULL when the row is good)."""
    extra = [c for c in text_df.columns if c not in spec.columns]
    # values first, messages from them: each value is converted once
    typed = text_df.select(
        *[convert(F.col(c), parse_declared(spec.types.get(c, "VARCHAR(8000)"))).alias(c) for c in spec.columns],
        *extra, *[F.col(c).alias(f"_raw_{c}") for c in spec.columns])
    reasons = F.concat_ws("; ", *_messages(spec))
    return typed.select(
        *spec.columns, *extra, F.nullif(reasons, F.lit("")).alias(REASONS),
        *[f"_raw_{c}" for c in spec.columns])


@dataclass
class TypedLoad:
    good: DataFrame
    rejects: DataFrame


def split(text_df: DataFrame, spec: DimensionSpec, persist: bool = False) -> TypedLoad:
    """K-02: good rows (typed, without helper columns) and reject rows.

    Rejects carry the raw text of each mapped column and the reason. With
    ``persist=True`` the checked frame is kept (memory and disk) so both
    writes read the source once.
    """
    checked = check_rows(text_df, spec)
    if persist:
        checked = checked.persist(StorageLevel.MEMORY_AND_DISK)
    raw = [f"_raw_{c}" for c in spec.columns]
    good = checked.filter(F.col(REASONS).isNull()).drop(REASONS, *raw)
    rejects = checked.filter(F.col(REASONS).isNotNull()).select(
        *[F.col(f"_raw_{c}").alias(c) for c in spec.columns],
        *[c for c in text_df.columns if c not in spec.columns],
        F.col(REASONS).alias("Rejected_Reason"))
    return TypedLoad(good, rejects)
