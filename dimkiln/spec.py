"""DimensionSpec: what a dimension looks like, built from mapping metadata.

A mapping has one row per column: ``Source_Column``, ``Target_Column``,
``Data_Type``, ``Is_PK``, ``Is_Type2_Attribute``, ``Is_Required`` and an
ordering column (``File_Mapping_SK``). It is metadata (tens of rows per
source), so it is collected on the driver once and turned into a frozen spec.
A dimension is Type 2 when any column is a Type 2 attribute.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable, Iterable, Mapping

from pyspark.sql import DataFrame

# Audit columns that the dimension layout adds itself; a mapping
# row naming one of them is dropped (decision D-15).
SK_SUFFIX = "_SK"
INSERTED = "Inserted_Datetime"
UPDATED = "Updated_Datetime"
IS_DELETED = "Is_Deleted"
REASON = "Row_Change_Reason"
IS_CURRENT = "Row_Is_Current"
EFFECTIVE = "Row_Effective_Datetime"
EXPIRY = "Row_Expiry_Datetime"
RESERVED_COLUMNS = (INSERTED, UPDATED, IS_DELETED, REASON, IS_CURRENT, EFFECTIVE, EXPIRY)

# Change reasons written into Row_Change_Reason.
REASON_NEW = "NEW"
REASON_DELETED = "Soft Deleted"
REASON_REACTIVATED = "Reactivated"


def flag_value(v) -> bool:
    """Driver-side flag parse (P-12): numeric 1 in any spelling is true.

    ``1``, ``1.0``, ``'1'``, ``' 1 '``, ``True`` are true; blank, NULL and
    anything that is not a number are false. Same rule as
    ``functions.flags.parse_flag`` on a Column.
    """
    if v is None:
        return False
    if isinstance(v, bool):
        return v
    try:
        return float(str(v).strip()) == 1.0
    except ValueError:
        return False


def sk_column_for(table_name: str) -> str:
    """SK column of a dimension table: ``Dim_Places`` -> ``Places_SK`` (P-15)."""
    bare = table_name.strip().strip("[]").split(".")[-1].strip("[]")
    return bare.replace("Dim_", "") + SK_SUFFIX


def qualify(table_name: str, default_schema: str = "dbo") -> str:
    """Default schema for an unqualified name and bracket removal (P-14)."""
    parts = [p.strip().strip("[]") for p in table_name.split(".")]
    if len(parts) == 1:
        parts = [default_schema] + parts
    return ".".join(parts)


@dataclass(frozen=True)
class DimensionSpec:
    """Column roles of one dimension.

    ``keys`` is the natural key (all PK columns, decision D-4), ``type1`` the
    columns overwritten in place, ``type2`` the columns that open a new
    version. ``merge`` optionally replaces the default merge operator with a
    callable ``(dim_df, stg_df, run_ts) -> MergeResult``. ``collation`` (for
    example ``UTF8_LCASE_RTRIM``: case- and trailing-space-insensitive) is
    applied to text keys and text change tests; default is binary.
    """

    name: str
    keys: tuple[str, ...]
    type1: tuple[str, ...] = ()
    type2: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    types: Mapping[str, str] = field(default_factory=dict)
    source_columns: Mapping[str, str] = field(default_factory=dict)
    sk_col: str | None = None
    merge: Callable | None = None
    collation: str | None = None

    def __post_init__(self):
        if not self.keys:
            raise ValueError(f"dimension {self.name!r} has no key column")
        overlap = set(self.type1) & set(self.type2)
        if overlap:
            raise ValueError(f"columns both type 1 and type 2: {sorted(overlap)}")

    @property
    def is_scd2(self) -> bool:
        return bool(self.type2)

    @property
    def sk(self) -> str:
        return self.sk_col or f"{self.name}{SK_SUFFIX}"

    @property
    def columns(self) -> tuple[str, ...]:
        """Mapped target columns: keys, then type 1, then type 2."""
        return tuple(self.keys) + tuple(self.type1) + tuple(self.type2)

    def audit_columns(self) -> tuple[str, ...]:
        base = (INSERTED, UPDATED, IS_DELETED, REASON)
        return base + ((IS_CURRENT, EFFECTIVE, EXPIRY) if self.is_scd2 else ())


def specs_rows(mapping: DataFrame, sources: Iterable[str],
               order_col: str = "File_Mapping_SK") -> dict[str, list[dict]]:
    """F-03, W-03: the live mapping rows of each source in order, in one collect."""
    from pyspark.sql import functions as F
    df = mapping.filter(F.col("Source_Name").isin(list(sources)))
    if "Row_Is_Current" in df.columns:
        df = df.filter(F.col("Row_Is_Current") == 1)
    if "Is_Deleted" in df.columns:
        df = df.filter(~F.coalesce(F.col("Is_Deleted").cast("string") == "1", F.lit(False)))
    df = df.filter(F.col("Target_Column").isNotNull())
    if order_col in df.columns:
        df = df.orderBy(order_col)
    out: dict[str, list[dict]] = {}
    for r in df.collect():
        out.setdefault(r["Source_Name"], []).append(r.asDict())
    return out


def spec_from_mapping(name: str, rows: Iterable[Mapping] | DataFrame,
                      source_name: str | None = None, sk_col: str | None = None,
                      order_col: str = "File_Mapping_SK") -> DimensionSpec:
    """Build a spec from mapping rows (dicts) or a mapping DataFrame.

    A DataFrame is filtered to ``source_name`` (default ``name``), restricted
    to non-deleted rows with a target (F-03) and ordered by ``order_col``
    (W-03) before the small result is collected.
    """
    if isinstance(rows, DataFrame):
        rows = specs_rows(rows, [source_name or name], order_col).get(source_name or name, [])
    keys, t1, t2, req = [], [], [], []
    types, src = {}, {}
    for r in rows:
        target = (r.get("Target_Column") or "").strip()
        if not target or target in RESERVED_COLUMNS:
            continue
        types[target] = (r.get("Data_Type") or "VARCHAR(8000)").strip()
        if r.get("Source_Column"):
            src[r["Source_Column"].strip()] = target
        if flag_value(r.get("Is_Required")):
            req.append(target)
        if flag_value(r.get("Is_PK")):
            keys.append(target)
        elif flag_value(r.get("Is_Type2_Attribute")):
            t2.append(target)
        else:
            t1.append(target)
    return DimensionSpec(name=name, keys=tuple(keys), type1=tuple(t1), type2=tuple(t2),
                         required=tuple(req), types=types, source_columns=src, sk_col=sk_col)
