"""Replacing a table, or some of its partitions, so that a failure never loses rows.

New rows are written to a hidden folder beside the table. Nothing of the table is touched until they are
complete. A journal beside the table then names what goes and what comes; old partitions are moved aside, new ones are
moved in, the journal is deleted and, after it, what was moved aside. Where a run was cut off, the next write of
the table, or ``recover``, finishes a switch that has a journal and throws away rows that have none. One
writer at a time may replace parts of a table.

Moving is renaming, which is quick on HDFS and local disks; on object stores it copies.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession

from forecourt.sources.files import Files


def _split(path: str) -> tuple[str, str]:
    folder, _, name = path.rstrip("/").rpartition("/")
    return folder, name


def stage(path: str) -> str:
    """A new hidden folder beside a table, for rows that aren't its own yet."""
    folder, name = _split(path)
    return f"{folder}/.{name}.staged-{uuid.uuid4().hex}"


def discard(spark: SparkSession, staged: str) -> None:
    folder, name = _split(staged)
    Files(spark, folder).remove(name)


def switch(spark: SparkSession, path: str, staged: str, parts: Sequence[str] | None = None) -> None:
    """Put staged rows in the place of the whole table or, with ``parts``, of the partitions that match these patterns.

    Partitions that match and have no new rows vanish.
    """
    folder, name = _split(path)
    files = Files(spark, folder)
    new = _split(staged)[1]
    if parts is None:
        drop, bring = [""] if files.exists(name) else [], [""]
    else:
        old_ones = {f for p in parts for f in files.matching(f"{name}/{p}")}
        new_ones = {f for p in parts for f in files.matching(f"{new}/{p}")}
        drop = sorted(f[len(name) + 1 :] for f in old_ones)
        bring = sorted(f[len(new) + 1 :] for f in new_ones)
    journal = {"new": new, "old": f".{name}.old-{uuid.uuid4().hex}", "drop": drop, "bring": bring}
    files.write(f".{name}.journal", journal)
    _finish(files, name, journal)
    spark.catalog.refreshByPath(path)  # what the session has cached of the table is old now


def recover(spark: SparkSession, path: str) -> bool:
    """Finish a switch that was cut off, and remove rows that were never complete. Whether there was a switch."""
    folder, name = _split(path)
    files = Files(spark, folder)
    journal = files.read(f".{name}.journal")
    if journal:
        _finish(files, name, journal)
        spark.catalog.refreshByPath(path)
    for kind in ("staged-*", "old-*", "journal.draft-*"):
        for left in files.matching(f".{name}.{kind}"):
            files.remove(left)
    return journal is not None


def _finish(files: Files, name: str, journal: dict) -> None:
    """Every step looks at what is there, so doing it again after a failure does what is left."""

    def within(folder: str, part: str) -> str:
        return f"{folder}/{part}" if part else folder

    for part in journal["drop"]:
        here, aside = within(name, part), within(journal["old"], part)
        if files.exists(here) and not files.exists(aside):
            files.move(here, aside)
    for part in journal["bring"]:
        new = within(journal["new"], part)
        if files.exists(new):
            files.move(new, within(name, part))
    # Without the journal nothing is moved again; what is left over is only removed.
    files.remove(f".{name}.journal")
    files.remove(journal["old"])
    files.remove(journal["new"])
