"""Delimited extracts delivered by business departments."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from forecourt.operators.schema import TableSpec, clean_headers, conform, quoted, union_all

# The format all departments deliver.
FORMAT = {"sep": ";", "header": "true", "encoding": "iso-8859-1"}
# Lines end with a line feed, so a stray carriage return stays inside its field.
MULTILINE = {"multiLine": "true", "lineSep": "\n"}
HEADER_READERS = 16


def read_extract(
    spark: SparkSession,
    path: str | Sequence[str],
    spec: TableSpec | None = None,
    multiline: bool = False,
    constants: Mapping[str, str] | None = None,
    file_column: str | None = None,
) -> DataFrame:
    """Read extracts that share one header; every column is text.

    ``multiline`` accepts quoted fields with line breaks; headers are then cleaned
    and stray carriage returns removed from the values. Such a file cannot be split,
    so one task reads it. ``constants`` are columns the file itself does not carry,
    ``file_column`` names one that shows the file each row comes from.
    """
    options = FORMAT | (MULTILINE if multiline else {})
    paths = [path] if isinstance(path, str) else list(path)
    header = spark.read.options(**options).csv(paths[0]).columns
    schema = StructType([StructField(name, StringType()) for name in header])
    df = spark.read.options(**options).schema(schema).csv(paths)
    columns = [F.col(quoted(name)).alias(name.strip()) for name in header]
    if file_column:
        columns.append(F.col("_metadata.file_name").alias(file_column))
    df = df.select(*columns)
    if multiline:
        df = clean_headers(df)
        df = df.select(*(F.translate(F.col(quoted(c)), "\r", "").alias(c) for c in df.columns))
    df = df.withColumns({name: F.lit(value) for name, value in (constants or {}).items()})
    return conform(df, spec) if spec else df


def find_extracts(spark: SparkSession, folder: str, prefix: str) -> list[str]:
    """Paths of the files whose name starts with a prefix; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"{prefix}*").load(folder)
    return sorted(row.path for row in files.select("path").collect())


def read_extract_set(
    spark: SparkSession,
    folder: str,
    prefix: str,
    country: str | None = None,
    spec: TableSpec | None = None,
    multiline: bool = False,
    file_column: str | None = None,
) -> DataFrame:
    """All extracts with a name prefix as one frame, tagged with their country.

    Departments change headers over time, so files are grouped by header and each
    group is one scan. Headers are read several at a time.
    """
    options = FORMAT | (MULTILINE if multiline else {})
    groups: dict[tuple[str, ...], list[str]] = {}
    paths = find_extracts(spark, folder, prefix)
    with ThreadPoolExecutor(HEADER_READERS) as pool:
        headers = list(pool.map(lambda path: tuple(spark.read.options(**options).csv(path).columns), paths))
    for path, header in zip(paths, headers, strict=True):
        groups.setdefault(header, []).append(path)
    if not groups:
        raise FileNotFoundError(f"no extract {prefix}* in {folder}")
    constants = {"country": country} if country is not None else None
    return union_all(
        [read_extract(spark, paths, spec, multiline, constants, file_column) for paths in groups.values()]
    )


def export_csv(df: DataFrame, path: str) -> None:
    """Write a result as delimited files with a header."""
    df.write.mode("overwrite").csv(path, header=True)
