"""Balances carried forward: the last row of every key per reporting date, kept as a slice and brought up to a later date by the new rows only.

A history is a folder of Parquet partitions by day or month. The carried slice notes which files of each partition it has seen. The next one merges
the rows after its date into it with one keyed maximum. Files that partitions of the time before have gained since hold late rows, which are merged in
the same way. Partitions that lost or changed a file are corrected: the keys in them, and those whose carried row came from them, are
worked out from the history again, all others stay carried.
"""

from __future__ import annotations

from collections.abc import Collection
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from snapbook.operators.asof import history_of, last_balances, latest_by_day, opening_rows
from snapbook.sources.slices import SliceStore
from snapbook.session import cut

FORMATS = {"day": "%Y-%m-%d", "month": "%Y-%m"}


class History:
    """A history table in ``folder/<part>=<value>/``, with one partition for each day (2024-01-31) or month (2024-01) of ``eff``."""

    def __init__(self, spark: SparkSession, folder: str, eff: str = "oper_day", part: str = "oper_month", by: str = "month",
                 schema: T.StructType | None = None) -> None:
        self.spark, self.folder, self.eff, self.part, self.format = spark, folder.rstrip("/"), eff, part, FORMATS[by]
        self._schema = schema

    def partition(self, day: date) -> str:
        return day.strftime(self.format)

    def signatures(self) -> dict[str, dict[str, str]]:
        """For each partition its files by a mark of name, size and time; their listing is a job, no file is opened."""
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(self.folder)
        value = F.regexp_extract("path", f"/{self.part}=([^/]+)/", 1)
        mark = F.xxhash64("path", "length", "modificationTime").cast("string")
        found: dict[str, dict[str, str]] = {}
        for r in files.select(value.alias("part"), mark.alias("mark"), "path").collect():
            found.setdefault(r["part"], {})[r["mark"]] = r["path"]
        return found

    def read(self, after: date | None = None, upto: date | None = None, parts: Collection[str] | None = None, files: Collection[str] | None = None) -> DataFrame:
        """Rows after one day, up to another, of some partitions or some files; only the partitions and files in question are read."""
        reader = self.spark.read
        if self._schema is not None:
            kind = self._schema[self.eff].dataType if self.part == self.eff else T.StringType()
            reader = reader.schema(T.StructType([*(f for f in self._schema if f.name != self.part), T.StructField(self.part, kind)]))
        df = reader.parquet(self.folder) if files is None else reader.option("basePath", self.folder).parquet(*sorted(files))
        # Partition values are text of one length, so they sort as their dates do.
        value = F.date_format(F.col(self.part), "yyyy-MM-dd") if isinstance(df.schema[self.part].dataType, T.DateType) else F.col(self.part).cast("string")
        if after is not None:
            df = df.filter((value >= self.partition(after)) & (F.col(self.eff) > F.lit(after)))
        if upto is not None:
            df = df.filter((value <= self.partition(upto)) & (F.col(self.eff) <= F.lit(upto)))
        if parts is not None:
            df = df.filter(value.isin(sorted(parts)))
        return df.drop(self.part) if self.part != self.eff else df


class CarriedBalances:
    """Last balances per register and date, as slices ``name`` of a store. A register has one row per day."""

    def __init__(self, store: SliceStore, history: History, source: str, name: str = "carried_balance", key: str = "register_id") -> None:
        self.store, self.history, self.source, self.name, self.key = store, history, source, name, key

    def _start(self, day: date) -> date | None:
        """The latest carried date up to ``day``."""
        days = [d for d in self.store.days(self.name, self.source) if d <= day]
        return max(days, default=None)

    def merged(self, day: date, start: date, corrected: Collection[str], gained: Collection[str] = ()) -> DataFrame:
        """Last rows by ``day`` from the slice of ``start``, the rows after it and those of files gained since; keys of corrected partitions from the history."""
        eff = self.history.eff
        carried = self.store.read(self.name, self.source, start).drop("source", "date1")
        fresh = self.history.read(after=start, upto=day).select(*carried.columns)
        if corrected:
            now = self.history.read(upto=start, parts=corrected).select(self.key)
            before = carried.filter(F.date_format(eff, "yyyy-MM-dd" if len(next(iter(corrected))) > 7 else "yyyy-MM").isin(sorted(corrected))).select(self.key)
            keys = cut(now.unionByName(before).distinct())
            redone = history_of(self.history.read(upto=start).select(*carried.columns), keys, self.key)
            carried = carried.join(keys, self.key, "left_anti").unionByName(redone)
        if gained:
            # A register has one row per day, so a late row can only take the place of an older one.
            fresh = fresh.unionByName(self.history.read(upto=start, files=gained).select(*carried.columns))
        return latest_by_day(carried.unionByName(fresh), self.key, eff, day)

    def advance(self, day: date) -> int:
        """Publish the carried slice of ``day`` and return its row count; nothing to do when it is there and the history is as it was."""
        files = {p: f for p, f in self.history.signatures().items() if p <= self.history.partition(day)}
        seen = {p: sorted(f) for p, f in files.items()}
        start = self._start(day)
        if start is None:
            full = latest_by_day(self.history.read(upto=day), self.key, self.history.eff, day)
            return self.store.replace(full, self.name, self.source, day, note={"seen": seen})
        note = self.store.note(self.name, self.source, start)
        known, border = note["seen"], self.history.partition(start)
        # A slice noted by an earlier form, one digest for a partition, knows no file: all its partitions are corrected.
        corrected = {p for p, marks in known.items() if p <= border and (isinstance(marks, str) or not files.get(p, {}).keys() >= set(marks))}
        gained = [path for p, f in files.items() if p <= border and p not in corrected for mark, path in f.items() if mark not in known.get(p, ())]
        if start == day and not corrected and not gained:
            return note["rows"]
        return self.store.replace(self.merged(day, start, corrected, gained), self.name, self.source, day, note={"seen": seen})

    def rows(self, day: date) -> DataFrame:
        """The carried rows of a published date. They can stand for the whole history in any lookup as of that date."""
        return self.store.read(self.name, self.source, day).drop("source", "date1")

    def last(self, day: date) -> DataFrame:
        """The carried rows of a date, brought up to date first."""
        self.advance(day)
        return self.rows(day)

    def opening_balance(self, registers: DataFrame, day: date) -> DataFrame:
        """As ``asof.opening_balance``, from the carried rows."""
        return opening_rows(registers, last_balances(self.last(day), day))
