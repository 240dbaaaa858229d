"""Declared column types (mapping ``Data_Type``) and text -> typed conversion.

Spark runs with ANSI casts, where a bad value raises; the load path therefore
uses ``try_cast`` and reports a value that did not convert as a reject
reason instead of failing the job (P-08, K-02).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class DeclaredType:
    """A mapping type: Spark type name plus an optional length limit."""

    declared: str
    spark_type: str
    max_length: int | None = None
    is_bit: bool = False


_LEN = re.compile(r"^\s*(N?VARCHAR|N?CHAR|VARBINARY)\s*\(\s*(\d+|MAX)\s*\)\s*$", re.I)
_DEC = re.compile(r"^\s*(DECIMAL|NUMERIC)\s*\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)\s*$", re.I)

# Declared type name -> Spark type for names without arguments.
_SIMPLE = {
    "INT": "int", "INTEGER": "int", "BIGINT": "bigint", "SMALLINT": "smallint",
    "TINYINT": "smallint", "FLOAT": "double", "REAL": "float", "DATE": "date",
    "DATETIME": "timestamp_ntz", "DATETIME2": "timestamp_ntz",
    "SMALLDATETIME": "timestamp_ntz", "MONEY": "decimal(19,4)",
    "DECIMAL": "decimal(18,0)", "NUMERIC": "decimal(18,0)",
    "TEXT": "string", "NTEXT": "string", "UNIQUEIDENTIFIER": "string",
}
# Fixed value: length used when a type is not recognised.
FALLBACK_LENGTH = 8000


def parse_declared(declared: str) -> DeclaredType:
    """Map a declared type to Spark; unknown names become text of length 8000."""
    text = (declared or "").strip()
    m = _LEN.match(text)
    if m:
        n = None if m.group(2).upper() == "MAX" else int(m.group(2))
        return DeclaredType(text, "string", n)
    m = _DEC.match(text)
    if m:
        return DeclaredType(text, f"decimal({int(m.group(2))},{int(m.group(3) or 0)})")
    upper = re.sub(r"\(.*\)$", "", text).strip().upper()
    if upper == "BIT":
        return DeclaredType(text, "int", None, is_bit=True)
    if upper in _SIMPLE:
        return DeclaredType(text, _SIMPLE[upper])
    return DeclaredType(text, "string", FALLBACK_LENGTH)


def convert(text: Column, dt: DeclaredType) -> Column:
    """Text -> declared type; a value that does not convert becomes NULL.

    Empty text is NULL for non-text types (as a bulk load reads an empty
    field). BIT accepts what a boolean cast accepts (``1``/``0``/``true``...).
    A bare number is not a date: a cast would read it as a year, where a
    spreadsheet means a serial day.
    """
    if dt.spark_type == "string":
        return text
    value = F.trim(text)   # no cast to another type reads an empty text
    if dt.is_bit:
        return value.try_cast("boolean").cast("int")
    if dt.spark_type in ("date", "timestamp_ntz"):
        value = F.when(~value.rlike(r"^[+-]?[0-9]+([.][0-9]*)?$"), value)
    return value.try_cast(dt.spark_type)


def conversion_error(text: Column, value: Column, dt: DeclaredType) -> Column:
    """True where the text held something that did not convert or is too long."""
    if dt.spark_type == "string":
        if dt.max_length is None:
            return F.lit(False)
        return F.coalesce(F.length(text) > F.lit(dt.max_length), F.lit(False))
    return value.isNull() & text.isNotNull() & (F.trim(text) != "")
