"""Database tables over JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime
from itertools import pairwise

from pyspark.sql import DataFrame, DataFrameReader, SparkSession

from forecourt.operators.aggregates import varchar_widths


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    fetchsize: int = 10_000,
    split: tuple[str, int] | None = None,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read a table or a bracketed subquery with an alias.

    ``split`` names a column and a number of ranges; the database is asked for values that cut the rows
    into so many equal shares, and a task reads each. However the values are spread, no task gets much more than its
    share, unless a single value has more. Without it one task reads everything, which is only meant
    for small reference tables.
    """
    told = {**(properties or {}), "fetchsize": str(fetchsize)}

    def source(relation: str) -> DataFrameReader:
        return spark.read.format("jdbc").options(**told).option("url", url).option("dbtable", relation)

    if not split:
        return source(table).load()
    column, parts = split
    firsts = [row[0] for row in source(share_starts(table, column, parts)).load().collect()]
    return spark.read.jdbc(url, table, predicates=ranges(column, firsts), properties=told)


def share_starts(table: str, column: str, parts: int) -> str:
    """Subquery: the smallest value of each of ``parts`` equal shares of the rows, so at most that many rows."""
    shares = f"SELECT {column} AS v, NTILE({parts}) OVER (ORDER BY {column}) AS share FROM {table} WHERE {column} IS NOT NULL"
    return f"(SELECT MIN(v) AS low FROM ({shares}) shares GROUP BY share) firsts"


def ranges(column: str, firsts: Sequence[object]) -> list[str]:
    """Conditions that give every row to one task. Values below the first and missing ones go to the first task."""
    bounds = [_literal(v) for v in sorted(set(firsts))][1:]
    if not bounds:
        return ["1 = 1"]
    low = f"({column} < {bounds[0]} OR {column} IS NULL)"
    middle = [f"{column} >= {a} AND {column} < {b}" for a, b in pairwise(bounds)]
    return [low, *middle, f"{column} >= {bounds[-1]}"]


def _literal(value: object) -> str:
    """A value as SQL text that databases share."""
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value}'"
    if isinstance(value, date):
        return f"DATE '{value}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def publish_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    widths: Mapping[str, int] | bool = False,
    connections: int = 16,
    batchsize: int = 10_000,
    properties: Mapping[str, str] | None = None,
) -> None:
    """Replace the contents of a database table and keep its definition.

    ``widths`` sets the text widths if the table has to be created: given ones, or
    measured ones with ``True``, which is one number per text column. At most
    ``connections`` tasks write, in batches. Each commits once at its end, so a
    repeated task leaves no row twice; keep speculative execution off.
    """
    writer = df.write.format("jdbc").mode("overwrite").options(**(properties or {}))
    writer = writer.option("url", url).option("dbtable", table).option("truncate", "true")
    writer = writer.option("numPartitions", connections).option("batchsize", batchsize)
    if widths is True:
        widths = {row["column"]: row["width"] for row in varchar_widths(df).collect()}
    if widths:
        types = ", ".join(f"`{c}` VARCHAR({n})" for c, n in widths.items())
        writer = writer.option("createTableColumnTypes", types)
    writer.save()
