"""What a run has done so far, so that the same run, started again after a failure, goes on where it stopped."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Mapping

from pyspark.sql import SparkSession

from forecourt.sources.files import Files, content_of


class Contents:
    """Contents of folders, each listed once until it is written."""

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._known: dict[str, str] = {}

    def of(self, path: str) -> str:
        if path not in self._known:
            self._known[path] = content_of(self._spark, path)
        return self._known[path]

    def forget(self, path: str) -> None:
        """A folder was written: neither it, nor what lies in it or around it, is known any more."""
        related = [p for p in self._known if f"{p}/".startswith(f"{path}/") or f"{path}/".startswith(f"{p}/")]
        for p in related:
            del self._known[p]


class Ledger:
    """Finished steps of one request, in a small file below the root of the zones.

    A step counts as done only while the folders it read and the one it wrote are as it left them. The file goes
    when the run is complete, so a later run of the same request does everything anew.
    """

    def __init__(self, spark: SparkSession, root: str, request: Mapping[str, object]):
        text = json.dumps(dict(request), sort_keys=True, default=str)
        self._files = Files(spark, root)
        self._name = f".runs/{hashlib.sha256(text.encode()).hexdigest()[:32]}.json"
        self._request = text
        self._steps: dict[str, dict] = (self._files.read(self._name) or {}).get("steps", {})
        self.contents = Contents(spark)

    def _state(self, paths: Iterable[str]) -> dict[str, str]:
        return {p: self.contents.of(p) for p in sorted(set(paths))}

    def done(self, step: str, reads: Iterable[str], writes: Iterable[str]) -> bool:
        known = self._steps.get(step)
        return known is not None and known == {"reads": self._state(reads), "writes": self._state(writes)}

    def record(self, step: str, reads: Iterable[str], writes: Iterable[str]) -> None:
        """Note a finished step. What it wrote is listed anew."""
        before = self._state(reads)
        for path in writes:
            self.contents.forget(path)
        self._steps[step] = {"reads": before, "writes": self._state(writes)}
        self._files.write(self._name, {"request": self._request, "steps": self._steps})

    def close(self) -> None:
        self._files.remove(self._name)
