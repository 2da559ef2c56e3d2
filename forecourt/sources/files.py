"""Folders and small files of whatever file system a path belongs to, through Hadoop."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Files:
    """The file system of one folder. Names are relative to that folder; an empty name is the folder itself."""

    def __init__(self, spark: SparkSession, folder: str):
        self._files = spark._jvm.org.apache.hadoop.fs
        self._path = self._files.Path
        rename = getattr(self._files, "Options$Rename")
        self._over = spark.sparkContext._gateway.new_array(rename, 1)
        self._over[0] = rename.OVERWRITE
        self._io = spark._jvm.org.apache.commons.io.IOUtils
        self.folder = folder.rstrip("/")
        self._system = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())
        self._base = self._plain(self._system.makeQualified(self._path(self.folder)))

    @staticmethod
    def _plain(path) -> str:
        return path.toUri().getPath()

    def at(self, name: str):
        return self._path(f"{self.folder}/{name}" if name else self.folder)

    def exists(self, name: str) -> bool:
        return self._system.exists(self.at(name))

    def matching(self, pattern: str) -> list[str]:
        """Names that match a pattern with ``*``."""
        found = self._system.globStatus(self.at(pattern)) or []
        return sorted(self._plain(f.getPath())[len(self._base) + 1 :] for f in found)

    def move(self, name: str, to: str) -> None:
        """Rename within the folder; the target must not exist."""
        target = self.at(to)
        self._system.mkdirs(target.getParent())
        if self._system.exists(target) or not self._system.rename(self.at(name), target):
            raise OSError(f"can't move {self.folder}/{name} to {to}")

    def remove(self, name: str) -> None:
        self._system.delete(self.at(name), True)

    def read(self, name: str) -> dict | None:
        """A JSON file, or None where there is none."""
        if not self.exists(name):
            return None
        stream = self._system.open(self.at(name))
        try:
            return json.loads(self._io.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def write(self, name: str, value: dict) -> None:
        """A JSON file that appears whole or not at all. An older one of that name is replaced."""
        draft = f"{name}.draft-{uuid.uuid4().hex}"
        stream = self._system.create(self.at(draft), True)
        try:
            self._io.write(json.dumps(value, sort_keys=True), stream, "UTF-8")
        finally:
            stream.close()
        context = self._files.FileContext.getFileContext(self._system.getUri(), self._system.getConf())
        context.rename(self.at(draft), self.at(name), self._over)


def _listed(spark: SparkSession, path: str) -> DataFrame | None:
    """Names, sizes and times of all files below a folder, from Spark's own listing, however many there are."""
    try:
        return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).drop("content")
    except AnalysisException:
        return None


def _content() -> Column:
    one = F.xxhash64("path", "length", F.col("modificationTime").cast("double")).cast("decimal(38,0)")
    return F.concat_ws(":", F.count("*").cast("string"), F.sum(one).cast("string"))


def content_of(spark: SparkSession, path: str) -> str:
    """A short text that changes when a file below a folder comes, goes or changes; empty where there is none."""
    files = _listed(spark, path)
    n, content = files.agg(F.count("*"), _content()).first() if files is not None else (0, "")
    return content if n else ""


def contents_by_part(spark: SparkSession, path: str, partition_by: Sequence[str]) -> dict[str, str]:
    """The content of each partition of a table, by the partition's folder; a table without partitions is one of no name."""
    files = _listed(spark, path)
    if files is None:
        return {}
    pattern = "/".join(["", *(f"{c}=[^/]*" for c in partition_by), ""]) if partition_by else ""
    part = F.regexp_extract("path", f"({pattern})[^/]*$", 1)
    parts = files.groupBy(F.trim(part, F.lit("/")).alias("part")).agg(_content().alias("content"))
    return {r.part: r.content for r in parts.collect()}
