"""Tables stored by day, whose days are read from metadata.

The days come from the catalog (``SHOW PARTITIONS``) or from a listing of the table's folder,
never from a scan; rows of one day are read from that day's folder alone.
"""

from __future__ import annotations

import dataclasses
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions import dates
from granary.schemas import Entity
from granary.sources import commits, scans

PARTS = ["year", "month", "day"]


@dataclasses.dataclass(frozen=True)
class StoredTable:
    """A Parquet table at ``root``, partitioned by one date column or by year, month and day.
    With ``table`` its catalog entry tells the days."""

    spark: SparkSession
    root: str
    entity: Entity
    table: str | None = None

    @property
    def _column(self) -> str:
        return self.entity.partition_columns[0]

    def rows(self) -> DataFrame:
        """All days. A literal filter on the day keeps the other folders closed."""
        return scans.read_parquet_table(self.spark, self.root, self.entity)

    def _partitions(self) -> list[str]:
        if self.table:
            return [r[0] for r in self.spark.sql(f"SHOW PARTITIONS {self.table}").collect()]
        return commits.partitions(commits.Files(self.spark, self.root), self.root.rstrip("/"), self.entity.partition_columns)

    def days(self) -> list[dt.date]:
        """Days the table has folders for, in order; a day may be empty."""
        out = []
        for partition in self._partitions():
            values = [p.split("=", 1)[1] for p in partition.split("/")]
            if any(v == "__HIVE_DEFAULT_PARTITION__" for v in values):
                continue
            out.append(dt.date(*map(int, values)) if self.entity.partition_columns == PARTS else dates.to_day(values[0]))
        return sorted(out)

    def _folder(self, day: dt.date) -> str:
        if self.entity.partition_columns == PARTS:
            return f"{self.root.rstrip('/')}/year={day:%Y}/month={day:%m}/day={day:%d}"
        return f"{self.root.rstrip('/')}/{self._column}={day.isoformat()}"

    def between(self, start: dt.date | str, end: dt.date | str) -> DataFrame:
        """Rows of the days in [start, end], from their folders alone."""
        first, last = dates.to_day(start), dates.to_day(end)
        folders = [self._folder(d) for d in self.days() if first <= d <= last]
        schema = self.entity.struct(with_partition=True)
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.root).parquet(*folders)

    def on(self, day: dt.date | str) -> DataFrame:
        return self.between(day, day)

    def newest(self, as_of: dt.date | str) -> dt.date | None:
        """Newest day not after ``as_of`` that has rows.

        Folders tell the days; only a day that was emptied makes the one before be looked at.
        """
        last = dates.to_day(as_of)
        return next((d for d in reversed(self.days()) if d <= last and not self.on(d).isEmpty()), None)

    def newest_rows(self, as_of: dt.date | str) -> DataFrame:
        """Rows of the newest day not after ``as_of``, with the day as a literal in the plan."""
        day = self.newest(as_of)
        return self.on(dt.date.min) if day is None else self.on(day)

    def each_day(self, start: dt.date | str, end: dt.date | str) -> DataFrame:
        """For every day in [start, end] the rows ``newest_rows`` has, keyed by ``as_of``."""
        first, last = dates.to_day(start), dates.to_day(end)
        begin = self.newest(first)
        later = self.between(first + dt.timedelta(days=1), last).select(self._column).distinct().collect()
        known = ([begin] if begin else []) + sorted(r[0] for r in later)
        served = []
        for day, following in zip(known, [*known[1:], last + dt.timedelta(days=1)], strict=False):
            begun = max(day, first)
            served += [(begun + dt.timedelta(days=n), day) for n in range((following - begun).days)]
        # One row per day of the range.
        by_day = self.spark.createDataFrame(served, f"as_of date, {self._column} date")
        return self.between(known[0] if known else last, last).join(F.broadcast(by_day), self._column)
