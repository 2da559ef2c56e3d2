"""Publication of refined marts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from forecourt.fixed_values import SALT
from forecourt.functions.text import pseudonym
from forecourt.sources.databases import publish_jdbc


def pseudonymise(df: DataFrame, columns: Sequence[str], salt: str = SALT) -> DataFrame:
    """Replace identifiers by their salted hash; equal identifiers stay joinable."""
    return df.withColumns({c: pseudonym(c, salt) for c in columns})


def publish(
    df: DataFrame,
    url: str,
    table: str,
    id_columns: Sequence[str] = ("vehicle",),
    salt: str = SALT,
    widths: Mapping[str, int] | bool = False,
    properties: Mapping[str, str] | None = None,
) -> None:
    """Write a mart to the report database without plain identifiers."""
    hidden = pseudonymise(df, [c for c in id_columns if c in df.columns], salt)
    publish_jdbc(hidden, url, table, widths, properties=properties)
