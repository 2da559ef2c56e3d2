"""Sharding along a Hilbert curve.

Rows that are close in several metadata dimensions at once come to lie next to each other,
so every shard covers a small box of the dimensions and readers can skip the others. Only
DataFrame functions are used.

1. Every dimension is cut into ``2**bits`` ranges: texts at exact quantiles of their whole values, numbers
   at approximate quantiles.
2. The ranges of a row are a cell; the cell's place on the Hilbert curve orders the rows.
3. A range-partitioned sort gives every row its position in the whole order, and equal runs
   of positions are the shards.

The text is read once, in the first step; what is sorted are ids and metadata. Rows of a full
cell are ordered by their id, so a cell with a third of all rows still spreads over many tasks.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm.common import fresh, written

ROW_BITS = 33  # monotonically_increasing_id() holds the row in the lower 33 bits


def text_bounds(df: DataFrame, column: str, cells: int) -> list[str]:
    """Exact quantiles of a text column by whole values: the ``cells - 1`` values that cut the rows into equal shares.

    The different values are counted and sorted by range, and running sums within a range are moved up by
    the sums of the ranges before it. So a value with a third of all rows is one row here, and no task sees
    more than its range of values. Nulls don't count; without values there are no bounds.
    """
    value, n, row, part, before, through, total = fresh(df, "value", "n", "row", "part", "before", "through", "total")
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias(value)).agg(F.count("*").alias(n))
    ordered = written(
        counts.repartitionByRange(value).sortWithinPartitions(value).withColumn(row, F.monotonically_increasing_id())
    ).withColumn(part, F.shiftright(row, ROW_BITS))
    whole = Window.partitionBy()
    offsets = ordered.groupBy(part).agg(F.sum(n).alias(before)).select(
        part,
        F.sum(before).over(whole).alias(total),
        (F.sum(before).over(whole.orderBy(part)) - F.col(before)).alias(before),
    )
    running = ordered.withColumn(through, F.sum(n).over(Window.partitionBy(part).orderBy(row)))
    placed = running.join(F.broadcast(offsets), part).withColumn(through, F.col(through) + F.col(before))
    reached = [F.col(through) * cells >= F.col(total) * k for k in range(1, cells)]
    bounds = placed.agg(*[F.min(F.when(r, F.col(value))).alias(f"b{k}") for k, r in enumerate(reached)]).first()
    return [b for b in bounds if b is not None]


def quantised(df: DataFrame, axes: Mapping[str, str], bits: int) -> DataFrame:
    """Add integer columns with the range of other columns, 0 to ``2**bits - 1``. ``axes``: new name to old name.

    Texts are compared whole, in the order of their bytes. A null is in the lowest range. Boundaries are at
    most ``2**bits - 1`` values per axis.
    """
    cells = 1 << bits
    kinds = dict(df.dtypes)
    bounds = {new: text_bounds(df, old, cells) for new, old in axes.items() if kinds[old] == "string"}
    numeric = {new: old for new, old in axes.items() if new not in bounds}
    if numeric:
        steps = [k / cells for k in range(1, cells)]
        found = df.agg(*[F.percentile_approx(old, steps, 10_000).alias(new) for new, old in numeric.items()]).first()
        bounds |= {new: found[new] or [] for new in numeric}

    def place(new: str, old: str) -> Column:
        return sum((F.when(F.col(old) > F.lit(b), 1).otherwise(0) for b in bounds[new]), F.lit(0)).cast("int")

    return df.withColumns({new: place(new, old) for new, old in axes.items()})


def with_curve_index(df: DataFrame, axes: list[str], bits: int, name: str) -> DataFrame:
    """Add the Hilbert index of the cell given by integer columns of ``bits`` bits each.

    The method of Skilling (2004): undo the rotations from the top bit down, then Gray-code and
    interleave. Every step is a projection, so that Spark compiles all into one stage.
    """
    x = fresh(df, *[f"{name}_{k}" for k in range(len(axes))])
    df = df.withColumns({c: F.col(axis).cast("long") for c, axis in zip(x, axes, strict=True)})
    for q in range(bits - 1, 0, -1):
        low = (1 << q) - 1
        for k, c in enumerate(x):
            first, own = F.col(x[0]), F.col(c)
            high = F.shiftright(own, q).bitwiseAND(1) == 1
            swap = first.bitwiseXOR(own).bitwiseAND(low)
            changed = {x[0]: F.when(high, first.bitwiseXOR(low)).otherwise(first.bitwiseXOR(swap) if k else first)}
            if k:
                changed[c] = F.when(high, own).otherwise(own.bitwiseXOR(swap))
            df = df.withColumns(changed)
    gray = [F.col(x[0])]
    for c in x[1:]:
        gray.append(gray[-1].bitwiseXOR(F.col(c)))
    df = df.withColumns(dict(zip(x, gray, strict=True)))
    flips = F.lit(0).cast("long")
    for q in range(1, bits):
        flips = flips.bitwiseXOR(F.shiftright(F.col(x[-1]), q).bitwiseAND(1) * ((1 << q) - 1))
    df = df.withColumns({c: F.col(c).bitwiseXOR(flips) for c in x})
    index = F.lit(0).cast("long")
    for q in range(bits - 1, -1, -1):
        for c in x:
            index = F.shiftleft(index, 1).bitwiseOR(F.shiftright(F.col(c), q).bitwiseAND(1))
    return df.withColumn(name, index).drop(*x)


def with_positions(df: DataFrame, keys: list[str], name: str, total: str) -> DataFrame:
    """Number all rows in the order of ``keys`` from 0, and add their count.

    The sorted rows are written before they are counted, so that a repeated task can't number
    them differently. The table of offsets has one row per partition.
    """
    row, part, before = fresh(df, "row", "part", "before")
    ordered = written(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(row, F.monotonically_increasing_id())
    ).withColumn(part, F.shiftright(row, ROW_BITS))
    counts = ordered.groupBy(part).agg(F.count("*").alias(before))
    whole = Window.partitionBy()
    offsets = counts.select(
        part,
        F.sum(before).over(whole).alias(total),
        (F.sum(before).over(whole.orderBy(part)) - F.col(before)).alias(before),
    )
    position = F.col(before) + F.col(row).bitwiseAND((1 << ROW_BITS) - 1)
    return ordered.join(F.broadcast(offsets), part).withColumn(name, position).drop(row, part, before)


def hilbert_shards(df: DataFrame, axes: list[str], ids: list[str], shards: int, bits: int = 4) -> DataFrame:
    """Put rows into ``shards`` runs of the Hilbert order; sizes differ by one row at most.

    ``axes`` are numeric or text columns, ``ids`` order the rows of a cell. Adds ``hilbert``, ``shard``
    and ``slot``, the gapless place in the shard; columns of these names are replaced. Nulls lie in the
    lowest range of their axis and sort first. Repeated rows keep their number. With fewer rows than
    shards some shards are empty; an empty table gives an empty table.
    """
    df = df.drop("hilbert", "shard", "slot")
    cells = fresh(df, *[f"cell{k}" for k in range(len(axes))])
    placed = with_curve_index(quantised(written(df), dict(zip(cells, axes, strict=True)), bits), cells, bits, "hilbert")
    at, n = fresh(df, "position", "total")
    numbered = with_positions(placed.drop(*cells), ["hilbert", *ids], at, n)
    shard = F.floor(((F.col(at) + 1) * shards - 1) / F.col(n)).cast("int")
    start = F.floor(F.col("shard") * F.col(n) / shards).cast("long")
    return numbered.withColumn("shard", shard).withColumn("slot", F.col(at) - start).drop(at, n)


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, in the order of the slots; footers then hold narrow ranges of every axis."""
    shards = sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    shards.write.partitionBy("shard").parquet(path)
