"""A log kept in day partitions named by a manifest (X-07).

Rows lie in folders by the day of their time column; a manifest names the folders
of every day. Retention commits a manifest without the expired days: their rows are
neither read nor rewritten, only the one day that the limit cuts is read and
written anew. Appends add a folder to the days they touch, and ``compact`` joins
the folders of days that have collected many small ones.

Folders are never overwritten and the manifest, one line of JSON, is committed
last. A single writer is assumed.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dimkiln.sinks.buckets import BucketTable

DAY = "_day"
NO_DAY = "none"


class DayLog(BucketTable):
    """Day folders under ``root``; a row without a time has the day ``none`` and never expires.

    With ``monthly`` the folders hold a month each, for logs of few rows a day.
    """

    def __init__(self, spark: SparkSession, root: str, time_col: str, monthly: bool = False):
        super().__init__(spark, root)
        self.time_col, self.monthly = time_col, monthly

    def _days(self, df: DataFrame, number: int) -> dict[str, list[str]]:
        day = F.coalesce(F.date_format(F.col(self.time_col), "yyyy-MM" if self.monthly else "yyyy-MM-dd"), F.lit(NO_DAY))
        folders = self._write_rows(df.withColumn(DAY, day), number, DAY)
        return {d: [f] for d, f in folders.items()}

    def _named(self) -> tuple[dict[str, list[str]], StructType | None]:
        now = self.manifest()
        return ({}, None) if now is None else (now["folders"], StructType.fromJson(now["schema"]))

    def read(self, days: list[str] | None = None) -> DataFrame | None:
        """The log, or some of its days."""
        folders, schema = self._named()
        if schema is None:
            return None
        return self._rows([f for d, fs in folders.items() if days is None or d in days for f in fs], schema)

    def append(self, df: DataFrame) -> int:
        """Add rows; each day they touch gets one more folder."""
        folders, schema = self._named()
        number = self._next()
        rows = df if schema is None else df.select(*schema.names)
        for day, fresh in self._days(rows, number).items():
            folders.setdefault(day, []).extend(fresh)
        return self._commit(number, {"schema": rows.schema.jsonValue(), "folders": folders})

    def purge(self, run_ts: str, days: int) -> list[str]:
        """Forget rows older than ``days`` before ``run_ts``; returns the days dropped whole."""
        folders, schema = self._named()
        if schema is None:
            return []
        limit = dt.datetime.fromisoformat(run_ts) - dt.timedelta(days=days)
        edge = limit.strftime("%Y-%m" if self.monthly else "%Y-%m-%d")
        dropped = sorted(d for d in folders if d != NO_DAY and d < edge)
        left = {d: fs for d, fs in folders.items() if d not in dropped}
        number = self._next()
        if edge in left:
            kept = self.read([edge]).filter(F.col(self.time_col) >= F.lit(limit.isoformat(sep=" ")).cast("timestamp_ntz"))
            rest = self._days(kept, number)
            left.pop(edge)
            left.update(rest)
        self._commit(number, {"schema": schema.jsonValue(), "folders": left})
        return dropped

    def compact(self, most: int = 8) -> list[str]:
        """Write each day of more than ``most`` folders into one; returns these days."""
        folders, schema = self._named()
        crowded = sorted(d for d, fs in folders.items() if len(fs) > most)
        if crowded:
            number = self._next()
            folders.update(self._days(self.read(crowded), number))
            self._commit(number, {"schema": schema.jsonValue(), "folders": folders})
        return crowded
