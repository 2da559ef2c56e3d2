"""Parquet tables of the zones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.operators.filters import restrict
from forecourt.sources import commits
from forecourt.sources.files import Files, content_of, contents_by_part


def read_zone(
    spark: SparkSession, path: str, country: str | None = None, brand: str | None = None
) -> DataFrame:
    """A zone table, or its part for one country and brand.

    The filter is on the partition columns, so only the wanted folders are read and
    the columns stay in the result.
    """
    return restrict(spark.read.parquet(path), country, brand)


def write_zone(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    sort_within: Sequence[str] = (),
    only: Sequence[Mapping[str, object]] = (),
) -> None:
    """Write a zone table.

    Overwriting replaces the whole table. With ``only``, a list of partition values, it replaces these
    partitions and no others: rows outside are left out, and a partition that no longer has rows vanishes.
    Either way the new rows are complete before an old one goes (see ``commits``).
    Rows are gathered by partition so that each gets few files; the rebalancing splits a
    partition that holds much of the data over many tasks.
    """
    spark = df.sparkSession
    commits.recover(spark, path)
    if mode != "overwrite":
        _write(df, path, partition_by, sort_within, mode)
        return
    covered = [{c: v for c, v in values.items() if c in partition_by} for values in only]
    parts = None
    if covered and all(covered):
        inside = (reduce(Column.__and__, (F.col(c) == v for c, v in values.items())) for values in covered)
        df = df.filter(reduce(Column.__or__, inside))
        parts = [_pattern(spark, partition_by, values) for values in covered]
    staged = commits.stage(path)
    try:
        _write(df, staged, partition_by, sort_within, "errorifexists")
        if partition_by and not _keeps_any(spark, path, staged, partition_by, parts):
            # A table without rows has no partitions; one empty file still tells its columns.
            kinds = dict(df.dtypes)
            hollow = {c: "none" if kinds[c] == "string" else 0 for c in partition_by}
            empty = spark.createDataFrame([], df.drop(*partition_by).schema)
            empty.write.parquet("/".join([staged, *(f"{c}={v}" for c, v in hollow.items())]))
            parts = parts and [*parts, _pattern(spark, partition_by, hollow)]
    except BaseException:
        commits.discard(spark, staged)
        raise
    commits.switch(spark, path, staged, parts)


def _write(df: DataFrame, path: str, partition_by: Sequence[str], sort_within: Sequence[str], mode: str) -> None:
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_within:
        df = df.sortWithinPartitions(*partition_by, *sort_within)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def _pattern(spark: SparkSession, partition_by: Sequence[str], values: Mapping[str, object]) -> str:
    """The folders of some partition values, whatever the other columns above them."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    depth = max(partition_by.index(c) for c in values) + 1
    return "/".join(f"{c}={escape(str(values[c])) if c in values else '*'}" for c in partition_by[:depth])


def _keeps_any(spark: SparkSession, path: str, staged: str, partition_by: Sequence[str], parts: Sequence[str] | None) -> bool:
    """Whether the table will have a partition once the staged rows are in the place of ``parts``."""
    leaf = "/".join(f"{c}=*" for c in partition_by)
    if Files(spark, staged).matching(leaf):
        return True
    if parts is None:
        return False
    table = Files(spark, path)
    gone = {f for p in parts for f in table.matching("/".join([p, *leaf.split("/")[p.count("/") + 1 :]]))}
    return any(table.matching(f"{f}/*") for f in table.matching(leaf) if f not in gone)


LANDED, MANIFEST = "_landed.json", "_manifest.json"


class Landed:
    """What was copied to a folder, so that what hasn't changed isn't copied again."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._files = spark, Files(spark, folder)
        self._known: dict[str, dict] = self._files.read(LANDED) or {}

    def current(self, name: str, source: str, copy: str) -> bool:
        """Whether neither the source nor the copy has changed since the copy was made."""
        known = self._known.get(name)
        return known is not None and known == {"from": source, "to": content_of(self._spark, copy)}

    def record(self, name: str, source: str, copy: str) -> None:
        self._known[name] = {"from": source, "to": content_of(self._spark, copy)}
        self._files.write(LANDED, self._known)


def land(spark: SparkSession, tables: Mapping[str, Sequence[str]], src: str, dst: str) -> list[str]:
    """Copy tables into the landing zone; ``tables`` names their partition columns.

    A table whose files are those that were copied last is left alone. Returns the names of the others.
    """
    landed = Landed(spark, dst)
    copied = []
    for name, partition_by in tables.items():
        source, copy = content_of(spark, f"{src}/{name}"), f"{dst}/{name}"
        if not landed.current(name, source, copy):
            write_zone(spark.read.parquet(f"{src}/{name}"), copy, partition_by)
            landed.record(name, source, copy)
            copied.append(name)
    return copied


def snapshot(
    spark: SparkSession, tables: Mapping[str, Sequence[str]], src: str, dst: str, as_of: datetime
) -> str:
    """Keep a dated image of a set of tables and return its folder.

    Only partitions that have changed since the latest image are copied, and tables without partitions as a whole;
    a manifest says which image holds the others. So older images must stay as long as
    newer ones; ``read_image`` puts a table together.
    """
    images = Files(spark, dst)
    made = [name.partition("/")[0] for name in images.matching(f"image_as_of=*/{MANIFEST}")]
    name = f"image_as_of={as_of:%Y-%m-%d_%H-%M-%S}"
    earlier = max((m for m in made if m < name), default=None)
    before = images.read(f"{earlier}/{MANIFEST}") if earlier else {}
    manifest: dict[str, dict] = {}
    for table, partition_by in tables.items():
        found = contents_by_part(spark, f"{src}/{table}", partition_by)
        old = before.get(table, {})
        changed = sorted(p for p, content in found.items() if old.get(p, {}).get("content") != content)
        if changed:
            write_zone(_parts(spark, f"{src}/{table}", changed), f"{dst}/{name}/{table}", partition_by)
        manifest[table] = {p: {"content": c, "image": name if p in changed else old[p]["image"]} for p, c in found.items()}
    images.write(f"{name}/{MANIFEST}", manifest)
    return f"{dst}/{name}"


def read_image(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A table as it was when an image was made, from all images that hold parts of it."""
    dst, _, name = folder.rstrip("/").rpartition("/")
    manifest = Files(spark, dst).read(f"{name}/{MANIFEST}")
    if manifest is None:
        raise FileNotFoundError(f"{folder} is no complete image")
    held: dict[str, list[str]] = {}
    for part, entry in manifest[table].items():
        held.setdefault(entry["image"], []).append(part)
    frames = [_parts(spark, f"{dst}/{image}/{table}", sorted(parts)) for image, parts in sorted(held.items())]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), frames)


def _parts(spark: SparkSession, path: str, parts: Sequence[str]) -> DataFrame:
    return spark.read.option("basePath", path).parquet(*(f"{path}/{p}" if p else path for p in parts))
