"""Flag and boolean helpers (P-12)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_flag(c: Column | str) -> Column:
    """P-12: boolean true, and numeric 1 in any spelling (``1``, ``'1'``, ``' 1 '``,
    ``1.0``), is true.

    Blank, NULL, words in text and other numbers are false; never NULL. A
    boolean column is taken as it is, as ``spec.flag_value`` does.
    """
    col = F.col(c) if isinstance(c, str) else c
    is_bool = F.typeof(col) == "boolean"
    text = F.trim(col.cast("string"))
    return F.when(is_bool, F.coalesce(text == "true", F.lit(False))).otherwise(
        F.coalesce(text.try_cast("double") == F.lit(1.0), F.lit(False)))


def as_bit(c: Column) -> Column:
    """Boolean as 0/1 integer (the BIT columns of the dimension layout)."""
    return F.when(c, F.lit(1)).otherwise(F.lit(0))
