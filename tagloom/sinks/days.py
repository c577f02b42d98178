"""Partial results by day: a run reads one new day, and a corrected day takes its old one's place.

A day is a folder of Parquet files that is never changed; a manifest says which folder holds which day. Old days
are folded into one base, after which they can no longer be corrected.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType

from tagloom.sinks.store import Versions


class DayStates(Versions):
    """The states of one metric below ``root``; days are texts that sort by time, such as 2024-05-31."""

    def _now(self) -> dict:
        return self._content() or {"version": 0, "schema": None, "days": {}, "base": None, "until": ""}

    def days(self) -> list[str]:
        """Days that are held by themselves."""
        return sorted(self._now()["days"])

    def _write(self, state: DataFrame) -> str:
        folder = f"states/{uuid.uuid4().hex}"
        state.hint("rebalance").write.mode("errorifexists").parquet(f"{self.root}/{folder}")
        return folder

    def _next(self, now: dict, **changed) -> None:
        self._publish({**now, **changed, "version": now["version"] + 1})

    def put(self, day: str, state: DataFrame) -> None:
        """Adds a day, or replaces it as a whole."""
        now = self._now()
        if day <= now["until"]:
            raise ValueError(f"days up to {now['until']} are folded together, {day} can't be replaced")
        schema = StructType([StructField(f.name, f.dataType) for f in state.schema.fields]).jsonValue()
        if now["schema"] not in (None, schema):
            raise ValueError("the days before have other columns")
        self._next(now, schema=schema, days={**now["days"], day: self._write(state)})

    def read(self) -> DataFrame:
        """The rows of the base and of all days."""
        now = self._now()
        folders = [*now["days"].values(), *([now["base"]] if now["base"] else [])]
        if not folders:
            raise ValueError(f"no days at {self.root}")
        return self._read(now, folders)

    def _read(self, now: dict, folders: list[str]) -> DataFrame:
        schema = StructType.fromJson(now["schema"])
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{f}" for f in folders])

    def compact(self, until: str, merge: Callable[[DataFrame], DataFrame]) -> None:
        """Folds the days up to ``until`` into the base with ``merge``."""
        now = self._now()
        old = {d: f for d, f in now["days"].items() if d <= until}
        if not old:
            return
        parts = [*old.values(), *([now["base"]] if now["base"] else [])]
        base = self._write(merge(self._read(now, parts)))
        kept = {d: f for d, f in now["days"].items() if d not in old}
        self._next(now, days=kept, base=base, until=until)

    def vacuum(self) -> None:
        """Deletes the folders that the newest manifest doesn't name, and older manifests; not beside a writer."""
        now, files = self._now(), self._files()
        used = {*now["days"].values(), now["base"]}
        for name in self._names("states"):
            if f"states/{name}" not in used:
                files.delete(self._path("states", name), True)
        for version in self.versions()[:-1]:
            files.delete(self._path("manifests", f"{version:010d}.json"), False)
