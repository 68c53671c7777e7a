"""Documents that are read once: a registry or a list of places stays in memory until its file changes or it is let go."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from civigrid.sources.documents import package_rows, without_error
from civigrid.sources.gazetteer import read_places
from civigrid.sources.onefile import stamp


class Catalogue:
    """Registries and places by path, shared by all look-ups of a session.

    What was read is kept with the file's name, length and time of change; a file that was written anew is read anew, and
    the rows of the old one are let go. ``release`` lets go of one path or of all.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self._kept = spark, {}

    def _get(self, kind: str, path: str, read: Callable[[], DataFrame], ready: Callable[[DataFrame], DataFrame]) -> DataFrame:
        now, held = stamp(self.spark, path), self._kept.get((kind, path))
        if held and held[0] == now:
            return held[2]
        self._drop((kind, path))
        rows = read().cache()
        try:
            out = ready(rows)
        except Exception:
            rows.unpersist()
            raise
        self._kept[kind, path] = (now, rows, out)
        return out

    def package(self, path: str) -> DataFrame:
        """Entries for look-ups; the first invalid one is an error, and nothing is kept then."""
        return self._get("package", path, lambda: package_rows(self.spark, path), without_error)

    def places(self, path: str) -> DataFrame:
        return self._get("places", path, lambda: read_places(self.spark, path), lambda rows: rows)

    def _drop(self, key: tuple[str, str]) -> None:
        if key in self._kept:
            self._kept.pop(key)[1].unpersist()

    def release(self, path: str | None = None) -> None:
        for key in [k for k in self._kept if path in (None, k[1])]:
            self._drop(key)
