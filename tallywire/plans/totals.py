"""Totals per key that read only the days that changed."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywire.commits import CommitLog, HadoopFolder
from tallywire.sources.directories import day_rows
from tallywire.storage import delete


@dataclass(frozen=True)
class DayTotals:
    """Totals of each day of a sink that is written by day, kept in a folder of their own.

    ``refresh`` lists the sink's day folders, computes the totals of those whose files are
    others than last time, and commits them in one step; a sum over all time is then a sum over
    one row for each day and key. One writer at a time.
    """

    spark: SparkSession
    sink: str
    path: str
    schema: T.StructType
    key: str
    count: str
    fmt: str = "parquet"

    def _listed(self) -> dict[str, str]:
        """What tells a day's files from other files, by day."""
        folder = HadoopFolder(self.spark, self.sink)
        days = [name.removeprefix("day=") for name in folder.names() if name.startswith("day=")]
        return {day: HadoopFolder(self.spark, f"{self.sink}/day={day}").fingerprint() for day in sorted(days)}

    def changed(self) -> list[str]:
        """Days that are new, or have other files than at the last refresh, or none any more."""
        known, listed = self._known(), self._listed()
        return sorted(day for day in known.keys() | listed.keys()
                      if day not in known or known[day]["files"] != listed.get(day))

    def _known(self) -> dict[str, dict[str, str]]:
        return (CommitLog.of(self.spark, self.path).latest() or {"days": {}})["days"]

    def rows(self, days: list[str]) -> DataFrame:
        """Totals by day and key of the sink's rows, reading the folders of these days only."""
        rows = day_rows(self.spark, self.sink, self.schema, days, self.fmt)
        return (rows.where(F.col(self.key).isNotNull()).groupBy("day", self.key)
                .agg(F.sum(self.count).alias(self.count)))

    def refresh(self) -> list[str]:
        """Bring the totals up to date; the days that were computed."""
        log = CommitLog.of(self.spark, self.path)
        listed, known, days = self._listed(), self._known(), self.changed()
        if not days:
            return []
        folder = f"totals-{uuid.uuid4().hex}"
        there = [day for day in days if day in listed]
        if there:
            self.rows(there).write.partitionBy("day").parquet(f"{self.path}/{folder}")
        kept = {day: entry for day, entry in known.items() if day not in days}
        log.put(log.last() + 1, {"days": kept | {
            day: {"files": listed[day], "folder": folder} for day in there}})
        for old in {entry["folder"] for entry in known.values()} - {e["folder"] for e in kept.values()}:
            delete(self.spark, f"{self.path}/{old}")
        return days

    def totals(self) -> DataFrame:
        """Articles per key over all days, as of the last refresh; a null key is left out."""
        shape = T.StructType([self.schema[self.key], self.schema[self.count]])
        known = self._known()
        folders = HadoopFolder(self.spark, self.path)
        paths = [f"{self.path}/{entry['folder']}/day={day}" for day, entry in sorted(known.items())
                 if folders.has(f"{entry['folder']}/day={day}")]
        if not paths:
            return self.spark.createDataFrame([], shape)
        return (self.spark.read.schema(shape).parquet(*paths).groupBy(self.key)
                .agg(F.sum(self.count).alias(self.count)))
