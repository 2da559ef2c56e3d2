"""Joins of a fact with its dimensions.

Dimensions carry no broadcast hint: Spark broadcasts one when the size it measures
is below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it otherwise, and
splits the partitions of hot fact keys while the query runs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.functions.columns import ColumnLike, as_column, first_of

# Equal rows of a dimension are repeated in runs of so many.
REPEATED_RUN = 4096


@dataclass(frozen=True)
class DimSpec:
    """One dimension of a star.

    ``on`` lists shared key names or maps dimension keys to fact columns or
    expressions. ``columns`` selects what is attached (all but the keys by
    default). ``role`` prefixes the attached names, so that one table can be
    attached under several keys. ``many`` announces that the dimension may hold
    many rows per key, ``different`` that no two of these are equal.
    """

    frame: DataFrame
    on: Sequence[str] | Mapping[str, ColumnLike]
    how: str = "inner"
    columns: Sequence[str] | None = None
    role: str | None = None
    many: bool = False
    different: bool = False

    def keys(self) -> dict[str, ColumnLike]:
        return dict(self.on) if isinstance(self.on, Mapping) else {k: k for k in self.on}

    def attached(self) -> dict[str, str]:
        keys = self.keys()
        names = [c for c in self.frame.columns if c not in keys] if self.columns is None else self.columns
        return {c: f"{self.role}_{c}" if self.role else c for c in names}


def attach(fact: DataFrame, dims: Sequence[DimSpec]) -> DataFrame:
    """Join the fact with each dimension in turn; the key columns stay the fact's."""
    joined, columns = fact, list(fact.columns)
    for i, dim in enumerate(dims):
        keys, attached = dim.keys(), dim.attached()
        clash = sorted(set(attached.values()) & set(columns))
        if clash:
            raise ValueError(f"already present: {', '.join(clash)}; give the dimension a role")
        names = {k: f"__key_{i}_{j}" for j, k in enumerate(keys)}
        right = dim.frame.select(
            *(F.col(k).alias(name) for k, name in names.items()),
            # An alias that changes nothing can hide that two plans are equal and could share an exchange.
            *(F.col(c) if c == name else F.col(c).alias(name) for c, name in attached.items()),
        )
        columns += attached.values()
        if dim.how == "left" and dim.many:
            on = {names[k]: as_column(expr) for k, expr in keys.items()}
            joined = _left_many(joined, right, on, dim.different).select(*columns)
        else:
            condition = reduce(Column.__and__, (as_column(expr) == F.col(names[k]) for k, expr in keys.items()))
            joined = joined.join(right, condition, dim.how)
    return joined.select(*columns)


def _left_many(fact: DataFrame, right: DataFrame, on: Mapping[str, Column], different: bool) -> DataFrame:
    """Left join with a dimension that may hold very many rows for one key; ``on`` maps its keys to those of the fact.

    Adaptive execution splits both sides of an inner join but only the preserved side of an
    outer one. So rows with a match come from an inner join, and the others from an outer join with the different keys.
    Both deal the fact by the same keys, so Spark shuffles it once and uses that exchange twice. The keys are compared
    null-safe though the dimension's are never NULL: a plain comparison would filter one of the two facts, and they would
    differ. Equal rows of the dimension (unless all are ``different``) are counted, joined once and repeated afterwards, since
    very many of them take few bytes, which adaptive execution wouldn't split, but much memory.
    """
    right = right.filter(reduce(Column.__and__, (F.col(n).isNotNull() for n in on)))
    columns = [c for c in (*fact.columns, *right.columns) if c not in on]
    known = right.select(*(F.col(n).alias(f"{n}_known") for n in on)).distinct().withColumn("__found", F.lit(True))
    if not different:
        right = right.groupBy(*right.columns).agg(F.count("*").alias("__times"))
    matched = fact.join(right, reduce(Column.__and__, (e.eqNullSafe(F.col(n)) for n, e in on.items())), "inner")
    if not different:
        matched = _repeated(matched, "__times", columns)
    marked = fact.join(known, reduce(Column.__and__, (e.eqNullSafe(F.col(f"{n}_known")) for n, e in on.items())), "left")
    lone = marked.filter(F.col("__found").isNull()).select(*fact.columns)
    return matched.select(*columns).unionByName(lone, allowMissingColumns=True)


def _repeated(df: DataFrame, times: str, columns: Sequence[str]) -> DataFrame:
    """Every row as often as ``times`` says, in runs, so that no array is as long as a large number."""
    run = F.explode(F.sequence(F.lit(0).cast("long"), F.col(times) - 1, F.lit(REPEATED_RUN).cast("long")))
    length = F.least(F.lit(REPEATED_RUN).cast("long"), F.col(times) - F.col("__start")).cast("int")
    runs = df.select(*columns, times, run.alias("__start"))
    return runs.select(*columns, F.explode(F.array_repeat(F.lit(True), length)).alias("__again"))


def attach_label(
    df: DataFrame, ref: DataFrame, code: str, key: str, label: str, out: str | None = None
) -> DataFrame:
    """Attach the largest label of each code, keeping rows without one."""
    labels = max_label(ref, key, label).withColumnRenamed(label, out or label)
    return attach(df, [DimSpec(labels, {key: code}, "left")])


def max_label(ref: DataFrame, key: str, label: str) -> DataFrame:
    return ref.groupBy(key).agg(F.max(label).alias(label))


def merge_sources(
    a: DataFrame, b: DataFrame, on: Sequence[str], merged: Mapping[str, tuple[str, str]] | None = None
) -> DataFrame:
    """Everything either system knows.

    ``merged`` maps an output column to the column of ``a`` that wins and the column of ``b``
    that fills the gaps; both inputs disappear. An outer join can't split a hot key. So one aggregate
    tells for every key which systems have it, each system is given a row without values for the keys that only
    the other one has, and an inner join, which can be split, does the rest. Missing keys match nothing.
    """
    merged = merged or {}
    missing = reduce(Column.__or__, (F.col(k).isNull() for k in on))
    sides = [df.withColumn("__lone", F.when(missing, own).otherwise(0)) for own, df in ((1, a), (2, b))]
    keys = [*on, "__lone"]
    # One number tells which systems have a key, so both uses are the same plan, and the aggregate runs once.
    tagged = [df.select(*keys, F.lit(bit).alias("__in")) for bit, df in zip((1, 2), sides, strict=True)]
    presence = tagged[0].unionByName(tagged[1]).groupBy(*keys).agg(F.bit_or("__in").alias("__in"))
    left, right = (
        df.unionByName(presence.filter(F.col("__in") == other).select(*keys), allowMissingColumns=True)
        for df, other in zip(sides, (2, 1), strict=True)
    )
    names = {k: f"__right_{k}" for k in keys}
    same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()))
    both = left.join(right.withColumnsRenamed(names), same, "inner").drop("__lone", *names.values())
    used = {c for pair in merged.values() for c in pair}
    kept = [c for c in both.columns if c not in used]
    return both.select(*kept, *(first_of(x, y).alias(out) for out, (x, y) in merged.items()))


def missing_from(df: DataFrame, ref: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in the reference."""
    return df.join(ref.select(*on).distinct(), on=list(on), how="left_anti")


def join_all(frames: Sequence[DataFrame], on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join a list of frames on the same key."""
    return reduce(lambda left, right: left.join(right, on=list(on), how=how), frames)
