"""Change predicates used by the merges (F-04, §1.4).

A text column is changed when ``coalesce(d, '') <> coalesce(o, '')``: NULL
and the empty string are equal. Other types use null-safe inequality,
because ``coalesce(number, '')`` is an error under ANSI casts. An empty
column list is the constant false, which Catalyst folds away.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType


def _coll(c: Column, collation: str | None) -> Column:
    return F.collate(c, collation) if collation else c


def column_changed(d: Column, o: Column, is_text: bool, collation: str | None = None) -> Column:
    if is_text:
        return _coll(F.coalesce(d, F.lit("")), collation) != _coll(F.coalesce(o, F.lit("")), collation)
    return ~d.eqNullSafe(o)


def text_columns(schema: StructType) -> set[str]:
    return {f.name for f in schema.fields if isinstance(f.dataType, StringType)}


def any_changed(columns: Iterable[str], schema: StructType, d_prefix: str = "",
                o_prefix: str = "", collation: str | None = None) -> Column:
    """OR of ``column_changed`` over columns; ``lit(False)`` when empty."""
    text_cols = text_columns(schema)
    preds = [column_changed(F.col(f"{d_prefix}{c}"), F.col(f"{o_prefix}{c}"), c in text_cols,
                            collation) for c in columns]
    return reduce(lambda a, b: a | b, preds) if preds else F.lit(False)


def keys_equal(left: Iterable[str], right: Iterable[str], text_keys: Iterable[str] = (),
               collation: str | None = None) -> Column:
    """Plain equality over all key columns: NULL keys never match (§1.4).

    Text keys compare under ``collation`` when one is given (the join then
    hashes on collation keys, so it still shuffles by key).
    """
    text = set(text_keys)
    preds = [(_coll(F.col(a), collation) == _coll(F.col(b), collation)) if a in text
             else (F.col(a) == F.col(b)) for a, b in zip(left, right)]
    return reduce(lambda a, b: a & b, preds)
