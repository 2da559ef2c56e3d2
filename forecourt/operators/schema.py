"""Bring differently shaped inputs to one schema."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TableSpec:
    """How one layout becomes the common one.

    ``columns`` maps source names to ours and thereby selects, ``missing`` adds
    typed NULL columns, ``order`` fixes the final column order, ``types`` declares types.
    """

    columns: Mapping[str, str]
    missing: Mapping[str, str] = field(default_factory=dict)
    order: Sequence[str] = ()
    types: Mapping[str, str] = field(default_factory=dict)

    @property
    def output(self) -> tuple[str, ...]:
        return tuple(self.order) or (*self.columns.values(), *self.missing)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Select, rename, complete and order in a single projection."""
    known = {new: F.col(quoted(old)) for old, new in spec.columns.items()}
    known |= {new: known[new].try_cast(kind) for new, kind in spec.types.items()}
    known |= {new: F.lit(None).cast(kind) for new, kind in spec.missing.items()}
    return df.select(*(known[name].alias(name) for name in spec.output))


def clean_header(name: str) -> str:
    """Trim, drop line breaks and dashes, underscore for everything unsafe in a name."""
    name = re.sub(r"[\r\n-]", "", name.strip())
    return re.sub(r"[ ()=.';]", "_", name)


def clean_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*map(clean_header, df.columns))


def cast_all(df: DataFrame, columns: Iterable[str], kind: str) -> DataFrame:
    """Cast a list of columns; text that does not parse becomes NULL."""
    text = {c for c, t in df.dtypes if t == "string"}
    return df.withColumns(
        {c: F.col(c).try_cast(kind) if c in text else F.col(c).cast(kind) for c in columns}
    )


def stringify(df: DataFrame) -> DataFrame:
    """Every column as text, for tools that import text only."""
    return df.select(*(F.col(quoted(c)).cast("string").alias(c) for c in df.columns))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames, matched by column name, duplicates kept."""
    if not frames:
        raise ValueError("nothing to unite")
    return reduce(DataFrame.unionByName, frames)
