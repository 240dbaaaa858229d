"""Text clean-up and message columns (P-01..P-04, P-09..P-11, P-17).

All are Column -> Column built from Spark's own string functions, so they
stay inside whole-stage codegen.
"""

from __future__ import annotations

import re

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _whitespace_class() -> str:
    """Regex class body of every character Python treats as whitespace.

    Built by rule (``str.isspace``) over the Basic Multilingual Plane, with
    runs written as ranges and code points as ``\\x{..}`` so the same text
    works in Java regex (Spark) and RE2 (DuckDB oracle).
    """
    points = [c for c in range(0x10000) if chr(c).isspace()]
    runs, start, prev = [], points[0], points[0]
    for c in points[1:]:
        if c == prev + 1:
            prev = c
            continue
        runs.append((start, prev))
        start = prev = c
    runs.append((start, prev))
    out = []
    for a, b in runs:
        out.append(f"\\x{{{a:x}}}" if a == b else f"\\x{{{a:x}}}-\\x{{{b:x}}}")
    return "".join(out)


WHITESPACE = _whitespace_class()
# The same set as characters (for translate/btrim, which need no regex).
WHITESPACE_CHARS = "".join(chr(c) for c in range(0x10000) if chr(c).isspace())
# P-01 + P-02: backslash is replaced by a space and then collapsed with the
# whitespace around it, which equals treating it as whitespace.
SANITIZE_PATTERN = f"[{WHITESPACE}\\\\]+"
WS_RUN_PATTERN = f"[{WHITESPACE}]+"
EDGE_WS_PATTERN = f"^[{WHITESPACE}]+|[{WHITESPACE}]+$"


def sanitize(c: Column | str) -> Column:
    """P-01 + P-02: newline, CR, tab, backslash and whitespace runs -> one space; trim.

    Every whitespace character and the backslash is mapped to a space by
    ``translate`` (one pass, no regex), then runs of spaces collapse to one
    (the regex runs only on values that hold a double space); the result
    equals ``regexp_replace(c, SANITIZE_PATTERN, ' ')`` + trim.
    """
    col = F.col(c) if isinstance(c, str) else c
    spaced = F.translate(col, WHITESPACE_CHARS + "\\", " " * (len(WHITESPACE_CHARS) + 1))
    # most values hold no double space: a cheap test skips the regex for them
    collapsed = F.when(F.instr(spaced, "  ") > 0, F.regexp_replace(spaced, "  +", " ")) \
        .otherwise(spaced)
    return F.trim(collapsed)


def collapse_ws(c: Column | str) -> Column:
    """P-03 (mapping sheet): strip, collapse whitespace runs to one space, strip."""
    col = F.col(c) if isinstance(c, str) else c
    return F.trim(F.regexp_replace(col, WS_RUN_PATTERN, " "))


def strip_ws(c: Column | str) -> Column:
    """Python ``str.strip()``: remove whitespace of any kind at both ends."""
    col = F.col(c) if isinstance(c, str) else c
    return F.btrim(col, F.lit(WHITESPACE_CHARS))


def sanitize_frame(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Apply ``sanitize`` to every string column (or the given ones) in one projection.

    Columns tagged as text made from a number, date, timestamp or boolean
    (``sources.files.as_text_frame``) are left as they are: their text holds
    no edge or repeated whitespace and no backslash, so clean-up is identity.
    """
    names = list(columns) if columns is not None else [
        f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    typed = {f.name for f in df.schema.fields if "dimkiln.typed_origin" in (f.metadata or {})}
    return df.withColumns({n: sanitize(F.col(n)) for n in names if n not in typed})


def normalise_header(raw: str) -> str:
    """P-04: header text as a column name: spaces -> underscores, trimmed."""
    return raw.replace(" ", "_").strip()


def normalised_header(raw: Column | str) -> Column:
    """P-04 on a column of header texts, as ``normalise_header``."""
    col = F.col(raw) if isinstance(raw, str) else raw
    return F.btrim(F.replace(col, F.lit(" "), F.lit("_")))


def _name_parts(name: str) -> Column:
    return F.transform(F.split(F.col(name), r"\."), lambda p: F.btrim(F.btrim(p), F.lit("[]")))


def qualified(name: str, default_schema: str = "dbo") -> Column:
    """P-14 on a column of table names, as ``spec.qualify``."""
    parts = _name_parts(name)
    return F.array_join(F.when(F.size(parts) == 1, F.concat(F.array(F.lit(default_schema)), parts)).otherwise(parts), ".")


def sk_name(name: str) -> Column:
    """P-15 on a column of dimension names, as ``spec.sk_column_for``."""
    return F.concat(F.replace(F.element_at(_name_parts(name), -1), F.lit("Dim_"), F.lit("")), F.lit("_SK"))


def key_renames(columns: Iterable[str], key_columns: Iterable[str]) -> dict[str, str]:
    """P-04: rename a raw header only when its normalised form is a key column."""
    keys = set(key_columns)
    out = {}
    for raw in columns:
        clean = normalise_header(raw)
        if clean != raw and clean in keys:
            out[raw] = clean
    return out


def row_json(columns: Iterable[str]) -> Column:
    """P-09: the row as JSON text, NULL fields kept, non-ASCII kept."""
    return F.to_json(F.struct(*[F.col(c) for c in columns]), {"ignoreNullFields": "false"})


# Reject reason prefixes.
DUPLICATE_PREFIX = "DUPLICATE_RECORD: PK "
BULK_PREFIX = "BCP_REJECTED: "
PROCESSING_PREFIX = "PROCESSING_ERROR: "
REASON_TEXT_LIMIT = 200

# a line "ValueError: ..." or "package.SomeException: ..." of a Python trace
_NAMES_EXCEPTION = re.compile(r"^(?!org\.|java\.|at )[A-Za-z_][\w.]*(Error|Exception|Interrupt|Exit|Warning)\b(: |$)")


def duplicate_reason(keys: Iterable[str]) -> Column:
    """P-10: ``DUPLICATE_RECORD: PK k1=v1, k2=v2`` (NULL shown as ``NULL``)."""
    parts = [F.concat(F.lit(f"{k}="), F.coalesce(F.col(k).cast("string"), F.lit("NULL")))
             for k in keys]
    return F.concat(F.lit(DUPLICATE_PREFIX), F.concat_ws(", ", *parts))


def prefixed_reason(prefix: str, message: Column | str) -> Column:
    """P-11: prefix + first 200 characters of the stripped message."""
    col = F.col(message) if isinstance(message, str) else message
    return F.concat(F.lit(prefix), F.substring(strip_ws(col), 1, REASON_TEXT_LIMIT))


def last_line(message: Column | str) -> Column:
    """P-17: last line of an error message."""
    col = F.col(message) if isinstance(message, str) else message
    return F.element_at(F.split(col, "\n"), -1)


def error_line(exc: BaseException) -> str:
    """P-17: one readable line for an audit row: the error's class and its cause.

    The message of a failed Python task ends with the worker's own trace and its
    first line only points there: the cause is then the last line of that trace
    that names an exception. Otherwise it is the first line that is not blank.
    """
    lines = [line.strip() for line in str(exc).splitlines() if line.strip()]
    if any(line.startswith("Traceback (most recent call last)") for line in lines):
        named = [line for line in lines if _NAMES_EXCEPTION.match(line)]
        lines = named[-1:] or lines
    return f"{type(exc).__name__}: {lines[0]}" if lines else type(exc).__name__
