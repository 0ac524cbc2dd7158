"""Published datasets: one Parquet folder per dataset, one folder per slice, one folder per version of a slice.

A dated slice is ``source=…/date1=…``, an undated dictionary slice ``source=…``. A publication is written beside the store and then moved into
its slice as the next version (``v=…``) by one rename; the version with the largest number is the slice. So a slice changes as a whole or not
at all, a reader keeps the version it began with, and a writer whose slice has changed since it began is refused: the name of the next version
is taken. Exclusion rests on the file system's rename (see ``session.move_new``).
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Iterable, Mapping, Sequence
from datetime import date
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from snapbook.operators.asof import Names, as_list
from snapbook.session import (
    folder_exists, make_folder, matching_paths, move_new, read_note, remove_folder, sub_folders, write_note,
)

# Datasets whose slices the clearing step empties; the dictionaries stay.
DATED = ("guarantee", "pledge", "pledge_reject", "client", "schedule", "portfolio", "account", "loan")

_TAG = re.compile(r"[A-Za-z0-9_.\-]+\Z")
_PLACE = re.compile(r"/source=([^/]+)(?:/date1=([^/]+))?/(?:v=(\d+)|[^/]+)\Z")
_NOTE = "_publication.json"
# In place of a version: the one that is current when the call begins.
CURRENT = -1


class StaleWriter(RuntimeError):
    """The slice was published or cleared by another writer after this one began."""


def _stack(one: DataFrame, two: DataFrame) -> DataFrame:
    return one.unionByName(two, allowMissingColumns=True)


class SliceStore:
    """Reads and replaces the slices below one folder. The version before the current one stays for readers under way."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def _folder(self, name: str, source: str | None = None, day: date | None = None) -> str:
        path = f"{self.root}/{name}"
        if source is not None:
            if not _TAG.match(source):
                raise ValueError(f"source tag {source!r} cannot be a folder name")
            path += f"/source={source}"
            if day is not None:
                path += f"/date1={day.isoformat()}"
        return path

    def exists(self, name: str) -> bool:
        """Whether the dataset has been published at all."""
        return folder_exists(self.spark, self._folder(name))

    # --- versions ------------------------------------------------------------------------------------

    def _versions(self, name: str, dated: bool, source: str | None, day: date | None) -> dict[tuple[str, str | None], dict[int, str]]:
        """Folders of all versions by slice; files put straight into a slice's folder are its version 0. One listing."""
        pattern = self._folder(name) + f"/source={source or '*'}" + (f"/date1={day.isoformat() if day else '*'}" if dated else "") + "/*"
        found: dict[tuple[str, str | None], dict[int, str]] = {}
        for path in matching_paths(self.spark, pattern):
            place = _PLACE.search(path)
            if place and (place[2] is not None) == dated:
                if place[3]:
                    found.setdefault((place[1], place[2]), {})[int(place[3])] = path
                elif not path.rpartition("/")[2].startswith(("_", ".")):
                    found.setdefault((place[1], place[2]), {})[0] = path.rpartition("/")[0]
        return found

    def version(self, name: str, source: str, day: date | None = None) -> int | None:
        """Number of a slice's current version; None without one."""
        one = self._versions(name, day is not None, source, day)
        return max(next(iter(one.values()))) if one else None

    def days(self, name: str, source: str) -> list[date]:
        """Dates of a source's slices, in order; a listing."""
        return sorted(date.fromisoformat(day) for _, day in self._versions(name, True, source, None))

    def note(self, name: str, source: str, day: date | None = None) -> dict[str, Any]:
        """What the current publication of a slice left about itself: its id, row count and whatever the publisher added."""
        one = self._versions(name, day is not None, source, day)
        text = read_note(self.spark, f"{max(next(iter(one.values())).items())[1]}/{_NOTE}") if one else None
        return json.loads(text) if text else {}

    # --- declarations --------------------------------------------------------------------------------

    def _declaration(self, name: str) -> tuple[int, dict[str, Any] | None]:
        """Number and content of the newest declaration."""
        notes = matching_paths(self.spark, f"{self.root}/_schemas/{name}/*.json")
        if not notes:
            return 0, None
        return int(notes[-1].rpartition("/")[2].removesuffix(".json")), json.loads(read_note(self.spark, notes[-1]))

    def _settled(self, name: str, known: dict[str, Any]) -> dict[str, Any]:
        """A declaration without the columns whose publication never came about."""
        lost = set()
        for column, place, mark in known["pending"]:
            note = read_note(self.spark, f"{self._folder(name)}/{place}/{_NOTE}")
            if note is None or json.loads(note)["id"] != mark:
                lost.add(column)
        kept = [c for c in known["columns"]["fields"] if c["name"] not in lost]
        return {"dated": known["dated"], "columns": {"type": "struct", "fields": kept}, "pending": []}

    def declared(self, name: str) -> tuple[bool, T.StructType] | None:
        """Whether a dataset is dated, and its columns without the partition ones; None before its first publication.

        The declaration is kept beside the data and grows when a publication brings a new column, so no file's own schema decides
        what is read. A new column counts from the moment its publication is in place. A store without a declaration is declared from all its files.
        """
        known = self._declaration(name)[1]
        if known is not None:
            known = self._settled(name, known) if known["pending"] else known
            if known["columns"]["fields"]:
                return known["dated"], T.StructType.fromJson(known["columns"])
        if not self.exists(name) or not matching_paths(self.spark, f"{self._folder(name)}/*"):
            return None
        files = self.spark.read.option("mergeSchema", "true").parquet(self._folder(name)).schema
        return "date1" in files.names, T.StructType([f for f in files if f.name not in ("source", "date1", "v")])

    def _fits(self, name: str, new: T.StructType, dated: bool) -> list[T.StructField]:
        """The columns a publication adds to the declaration; one that does not fit it is refused."""
        known = self.declared(name)
        if known and known[0] != dated:
            raise ValueError(f"dataset {name} is published {'by' if known[0] else 'without'} date")
        have = {f.name: f.dataType for f in known[1]} if known else {}
        for f in new:
            if f.name in have and have[f.name] != f.dataType:
                raise ValueError(f"column {f.name} of {name} is {have[f.name].simpleString()}, not {f.dataType.simpleString()}")
        return [T.StructField(f.name, f.dataType) for f in new if f.name not in have]

    def _declare(self, name: str, new: T.StructType, dated: bool, place: str, mark: str) -> None:
        """Add a publication's new columns, pending until its folder is in place. Another declarer in between means another look."""
        while True:
            added = self._fits(name, new, dated)
            number, known = self._declaration(name)
            if known is not None and not added:
                return
            if known is None:
                old = self.declared(name)
                known = {"dated": dated, "columns": (old[1] if old else T.StructType([])).jsonValue(), "pending": []}
            known = self._settled(name, known)
            known["columns"]["fields"] += T.StructType(added).jsonValue()["fields"]
            known["pending"] = [[f.name, place, mark] for f in added]
            if self._put_declaration(name, number + 1, known):
                return

    def _put_declaration(self, name: str, number: int, content: dict[str, Any]) -> bool:
        draft = f"{self.root}/_staging/{uuid.uuid4().hex}.json"
        write_note(self.spark, draft, json.dumps(content))
        make_folder(self.spark, f"{self.root}/_schemas/{name}")
        done = move_new(self.spark, draft, f"{self.root}/_schemas/{name}/{number:08d}.json")
        if not done:
            remove_folder(self.spark, draft)
        return done

    def _settle(self, name: str) -> None:
        """Take pending columns into the declaration for good once their publication has come about."""
        number, known = self._declaration(name)
        if known and known["pending"]:
            self._put_declaration(name, number + 1, self._settled(name, known))

    # --- reading -------------------------------------------------------------------------------------

    def read(self, name: str, source: str | None = None, day: date | None = None) -> DataFrame:
        """A dataset or one slice of it with its declared columns, as published now; both filters prune partitions."""
        known = self.declared(name)
        if known is None:
            raise ValueError(f"dataset {name} has not been published")
        dated, columns = known
        parts = [T.StructField("source", T.StringType())] + ([T.StructField("date1", T.DateType())] if dated else [])
        whole = T.StructType([*columns, *parts])
        newest = [max(v.items()) for v in self._versions(name, dated, source, day if dated else None).values()]
        if source is not None:
            self._folder(name, source)
        # Version folders and files straight in a slice's folder differ in depth, so each kind is a read of its own.
        reads = [
            self.spark.read.schema(whole).option("basePath", self._folder(name)).parquet(*paths).select(*whole.names)
            for paths in ([p for n, p in newest if n], [p for n, p in newest if not n]) if paths
        ]
        df = reduce(DataFrame.unionByName, reads) if reads else self.spark.createDataFrame([], whole)
        if source is not None:
            df = df.filter(F.col("source") == source)
        if day is not None:
            df = df.filter(F.col("date1") == F.lit(day))
        return df

    # --- writing -------------------------------------------------------------------------------------

    def replace(self, df: DataFrame, name: str, source: str, day: date | None = None, since: int | None = CURRENT,
                note: Mapping[str, Any] | None = None) -> int:
        """Make ``df`` the whole slice and return its row count, taken by the writing job itself.

        A dataset is published by date or without; the other form is refused. ``since`` is the version the writer started from, the current one
        unless given. An empty result removes the slice. A failed job changes neither rows nor declaration. ``note`` is kept with the publication.
        """
        place = self._folder(name, source, day)
        plain = df.drop("source", "date1")
        self._fits(name, plain.schema, day is not None)
        if since == CURRENT:
            since = self.version(name, source, day)
        mark = uuid.uuid4().hex
        staged, seen = f"{self.root}/_staging/{mark}", Observation()
        try:
            plain.observe(seen, F.count(F.lit(1)).alias("rows")).write.option("compression", "zstd").parquet(staged)
            rows = seen.get.get("rows", 0)
            if rows:
                write_note(self.spark, f"{staged}/{_NOTE}", json.dumps({"id": mark, "rows": rows, **(note or {})}))
                self._publish(plain.schema, name, place, day is not None, since, staged, mark)
            else:
                self._unchanged(name, source, day, since)
                self._declare_empty(name, plain.schema, day is not None)
                self._remove(place)
        finally:
            remove_folder(self.spark, staged)
        return rows

    def _unchanged(self, name: str, source: str, day: date | None, since: int | None) -> None:
        if self.version(name, source, day) != since:
            raise StaleWriter(f"{self._folder(name, source, day)} was changed by another writer")

    def _declare_empty(self, name: str, schema: T.StructType, dated: bool) -> None:
        """Columns of an empty publication: nothing has to come into place, so they count at once."""
        while added := self._fits(name, schema, dated):
            number, known = self._declaration(name)
            known = self._settled(name, known or {"dated": dated, "columns": T.StructType([]).jsonValue(), "pending": []})
            known["columns"]["fields"] += T.StructType(added).jsonValue()["fields"]
            make_folder(self.spark, self._folder(name))
            if self._put_declaration(name, number + 1, known):
                return

    def _publish(self, schema: T.StructType, name: str, place: str, dated: bool, since: int | None, staged: str, mark: str) -> None:
        """Move a written publication into its slice. Numbers never come back, not even for a slice cleared in between."""
        source, day = re.search(r"/source=([^/]+)(?:/date1=([^/]+))?\Z", place).groups()
        date1 = date.fromisoformat(day) if day else None
        self._unchanged(name, source, date1, since)
        following = since + 1 if since else int(time.time() * 1000)
        target = f"{place}/v={following}"
        self._declare(name, schema, dated, target.removeprefix(f"{self._folder(name)}/"), mark)
        if not since:
            make_folder(self.spark, place)
        if not move_new(self.spark, staged, target):
            raise StaleWriter(f"{place} was changed by another writer")
        versions = next(iter(self._versions(name, dated, source, date1).values()))
        if max(versions) != following:
            remove_folder(self.spark, target)
            raise StaleWriter(f"{place} was changed by another writer")
        self._settle(name)
        for number in sorted(versions)[:-2]:
            if number:
                remove_folder(self.spark, versions[number])

    def _remove(self, place: str) -> None:
        """Take a slice away in one rename, then delete its files."""
        gone = f"{self.root}/_staging/{uuid.uuid4().hex}"
        make_folder(self.spark, f"{self.root}/_staging")
        if move_new(self.spark, place, gone):
            remove_folder(self.spark, gone)

    def append_to(self, parts: Sequence[DataFrame], name: str, source: str, day: date | None = None, since: int | None = CURRENT) -> int:
        """Several result sets of one slice, written once."""
        return self.replace(reduce(_stack, parts), name, source, day, since)

    def replace_objects(self, df: DataFrame, name: str, source: str, day: date, key: str, ids: Iterable) -> int:
        """Replace only the rows of the given objects and keep the rest of the slice."""
        if not self.exists(name):
            return self.replace(df, name, source, day)
        since = self.version(name, source, day)
        kept = self.read(name, source, day).filter(~F.coalesce(F.col(key).isin(list(ids)), F.lit(False)))
        return self.replace(_stack(kept.drop("source", "date1"), df.drop("source", "date1")), name, source, day, since)

    def replace_matching(self, df: DataFrame, name: str, source: str, day: date, key: Names, ids: DataFrame) -> int:
        """As ``replace_objects`` with the ids in a frame of any size."""
        if not self.exists(name):
            return self.replace(df, name, source, day)
        keys, since = as_list(key), self.version(name, source, day)
        kept = self.read(name, source, day).join(ids.select(*keys).distinct(), keys, "left_anti")
        return self.replace(_stack(kept.drop("source", "date1"), df.drop("source", "date1")), name, source, day, since)

    def delete_where(self, name: str, source: str, day: date, pred: Column) -> int:
        """Remove the rows of a slice for which the predicate is true; unknown keeps the row."""
        since = self.version(name, source, day) if day is not None else CURRENT
        kept = self.read(name, source, day).filter(~F.coalesce(pred, F.lit(False)))
        return self.replace(kept, name, source, day, since)

    def clear_range(self, names: Iterable[str], source: str, start: date | None, finish: date | None) -> list[tuple[str, date]]:
        """Remove every slice of the period, both ends included; nothing when start is after finish. None leaves an end open.

        The dates come from the names of the slice folders: a listing, renames and deletions, no job and no empty files.
        """
        cleared = []
        for name in names:
            for folder in sub_folders(self.spark, self._folder(name, source)):
                if folder.startswith("date1="):
                    day = date.fromisoformat(folder.removeprefix("date1="))
                    if (start is None or start <= day) and (finish is None or day <= finish):
                        self._remove(self._folder(name, source, day))
                        cleared.append((name, day))
        return cleared

    def clear(self, names: Iterable[str], source: str, day: date | None) -> list[tuple[str, date]]:
        """Remove the slices of one date, or of every date when ``day`` is None."""
        return self.clear_range(names, source, day, day)

    def counts(self, names: Sequence[str], source: str, day: date | None = None) -> DataFrame:
        """Rows per dataset for one source and date (all dates when none is given)."""
        parts = [
            self.read(n, source, day).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("dataset"), "row_count")
            for n in names
        ]
        return reduce(DataFrame.unionByName, parts)
