"""Skew-safe building blocks: top-1 per key, global numbering, running totals.

A window over one hot key, or over no key at all, sends that key's rows to a
single task. Everything here either aggregates map-side first (``top_per_key``)
or splits the order by range and adds per-range offsets (``row_numbers``,
``running_totals``), so no task holds more than one range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leasegrid.session import cut_lineage, exchanged

_PART = "__part"
_OFFSET = "__offset"


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def top_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], largest: bool = True
) -> DataFrame:
    """One whole row per key: the one with the largest (or smallest) ``order`` tuple.

    The tuple must end in a unique column. Rows with a NULL key form one group
    each key value, as GROUP BY does. Partial aggregation keeps at most one row
    per key and task before the shuffle, so hot keys cost nothing extra.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[_as_col(c).alias(f"o{i}") for i, c in enumerate(order)])
    pick = F.max_by if largest else F.min_by
    best = df.groupBy(*keys).agg(pick(F.struct(*rest), rank).alias("__row"))
    out = best.select(*keys, *[F.col("__row")[c].alias(c) for c in rest])
    return out.select(*df.columns)


def row_numbers(df: DataFrame, order: Sequence[Column | str], name: str = "row_number") -> DataFrame:
    """Global 1-based row number in ``order`` (which must be unique), without a global window.

    Range-partition and sort, freeze the partition-local position, then add
    the row counts of the earlier ranges. The offsets table has one row per
    partition, which bounds its broadcast.
    """
    order = [_as_col(c) for c in order]
    ranged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(_PART, F.monotonically_increasing_id())
    )
    frozen = cut_lineage(ranged)
    part = F.shiftright(F.col(_PART), 33)
    local = F.col(_PART).bitwiseAND(F.lit((1 << 33) - 1))
    counts = frozen.groupBy(part.alias("__p")).agg(F.count("*").alias("__n"))
    before = Window.partitionBy(F.lit(0)).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__p", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias(_OFFSET))
    return (
        frozen.withColumn("__p", part)
        .join(F.broadcast(offsets), "__p")
        .withColumn(name, F.col(_OFFSET) + local + 1)
        .drop(_PART, _OFFSET, "__p")
    )


def running_totals(
    df: DataFrame,
    order: Sequence[Column | str],
    weight: str,
    by: Sequence[str] = (),
    name: str = "running",
    total: str | None = None,
) -> DataFrame:
    """Inclusive running sum of ``weight`` per ``by`` group in ``order``, split by range.

    ``total`` names an extra column with the group's grand total. Order keys
    must be unique within a group.
    """
    order = [_as_col(c) for c in order]
    keys = [F.col(k) for k in by]
    whole = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    frozen = cut_lineage(df.repartitionByRange(*keys, *order).withColumn(_PART, F.spark_partition_id()))
    parts = frozen.groupBy(*by, _PART).agg(F.sum(weight).alias("__t"))
    before = whole.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        *by,
        _PART,
        F.coalesce(F.sum("__t").over(before), F.lit(0)).alias(_OFFSET),
        *([F.sum("__t").over(whole).alias(total)] if total else []),
    )
    local = Window.partitionBy(*by, _PART).orderBy(*order)
    # ``by`` may have as many groups as rows; the window needs this exchange anyway
    return (
        frozen.join(exchanged(offsets), [*by, _PART])
        .withColumn(
            name,
            F.col(_OFFSET)
            + F.sum(weight).over(local.rowsBetween(Window.unboundedPreceding, 0)),
        )
        .drop(_PART, _OFFSET)
    )


def forward_fill(
    df: DataFrame, unit: Sequence[str], order: Sequence[Column | str], value: str, name: str | None = None
) -> DataFrame:
    """Last non-null ``value`` so far per unit, in ``order`` (unique per unit).

    Rows are range-partitioned by (unit, order). Each range fills itself; what
    an earlier range of the same unit ended with is carried in by a join on
    (unit, range), so even one unit with most of the rows is split.
    """
    order = [_as_col(c) for c in order]
    v = F.col(value)
    frozen = cut_lineage(
        df.repartitionByRange(*[F.col(u) for u in unit], *order).withColumn(_PART, F.spark_partition_id())
    )
    ends = frozen.groupBy(*unit, _PART).agg(F.max_by(value, F.when(v.isNotNull(), F.struct(*order))).alias("__e"))
    earlier = Window.partitionBy(*unit).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*unit, _PART, F.last("__e", ignorenulls=True).over(earlier).alias("__in"))
    local = Window.partitionBy(*unit, _PART).orderBy(*order)
    filled = F.coalesce(F.last(value, ignorenulls=True).over(local), F.col("__in"))
    out = frozen.join(carried, [*unit, _PART]).withColumn(name or value, filled)
    return out.drop(_PART, "__in")


def dense_ids(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """0-based id of each distinct key in key order, joined back to every row."""
    distinct = df.select(*keys).where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)).distinct()
    ids = row_numbers(distinct, keys, "__id").select(*keys, (F.col("__id") - 1).alias(name))
    return df.join(ids, list(keys), "left")
