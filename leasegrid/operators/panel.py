"""Quarterly panels: roll-ups, lags, tails, trends.

Windows here run over one unit's periods. A panel has one row per unit and
period, so a unit's group is bounded by the number of periods; raw facts must
be rolled up first (``quarterly_rollup`` pre-aggregates map-side).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leasegrid.functions.dates import quarter_last_month


def quarterly_rollup(
    df: DataFrame,
    date: str,
    values: Sequence[str],
    method: str = "mean",
    by: Sequence[str] = (),
    tie: Sequence[str] = (),
) -> DataFrame:
    """(by, date, year, quarter, values): mean, first or last non-null value per quarter."""
    d = F.col(date)
    order = F.struct(date, *tie) if tie else d

    def agg(c: str) -> Column:
        if method == "mean":
            return F.avg(c).alias(c)
        pick = {"first": F.min_by, "last": F.max_by}[method]
        return pick(c, F.when(F.col(c).isNotNull(), order)).alias(c)

    out = (
        df.where(d.isNotNull())
        .withColumns({"__y": F.year(d), "__q": F.quarter(d)})
        .groupBy(*by, "__y", "__q")
        .agg(*[agg(c) for c in values])
    )
    return out.select(
        *by,
        quarter_last_month(F.col("__y"), F.col("__q")).alias("date"),
        F.col("__y").alias("year"),
        F.col("__q").alias("quarter"),
        *values,
    )


def first_per_period(df: DataFrame, keys: Sequence[str], values: Sequence[str], order: str) -> DataFrame:
    """First non-null value of each column per period."""
    pick = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in values]
    return df.groupBy(*keys).agg(*pick)


def _series(unit: Sequence[str], order: str) -> Window:
    return Window.partitionBy(*unit).orderBy(order)


def time_lags(
    df: DataFrame, unit: Sequence[str], order: str, value: str, lags: Sequence[int] = (1, 2, 3, 4), prefix: str = "rent_lag_"
) -> DataFrame:
    """Row lags per unit (missing periods are not filled)."""
    w = _series(unit, order)
    return df.withColumns({f"{prefix}{k}": F.lag(value, k).over(w) for k in lags})


def first_difference(df: DataFrame, unit: Sequence[str], order: str, value: str, name: str = "diff") -> DataFrame:
    return df.withColumn(name, F.col(value) - F.lag(value).over(_series(unit, order)))


def tail_values(
    df: DataFrame, unit: Sequence[str], order: str, value: str, n: int = 4, name: str = "tail", complete: bool = True
) -> DataFrame:
    """Last ``n`` values per unit, oldest first. ``complete`` drops shorter units.

    The rank filter is applied before the shuffle, so a hot unit leaves each
    task as at most ``n`` rows.
    """
    w = Window.partitionBy(*unit).orderBy(F.col(order).desc())
    last = df.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= n)
    items = F.sort_array(F.collect_list(F.struct(F.col("__r").alias("r"), F.col(value).alias("v"))), asc=False)
    out = last.groupBy(*unit).agg(F.transform(items, lambda x: x.v).alias(name))
    return out.where(F.size(name) == n) if complete else out


def baseline(
    df: DataFrame, unit: Sequence[str], order: str, value: str, name: str = "baseline_rent", min_rows: int = 2
) -> DataFrame:
    """Latest value per unit with at least ``min_rows`` rows."""
    out = df.groupBy(*unit).agg(F.max_by(value, order).alias(name), F.count("*").alias("__n"))
    return out.where(F.col("__n") >= min_rows).drop("__n")


def recent_trend(
    df: DataFrame, unit: Sequence[str], order: str, value: str, n: int = 4, name: str = "trend"
) -> DataFrame:
    """Mean first difference of the last ``n`` non-null values (the sum telescopes)."""
    tails = tail_values(df.where(F.col(value).isNotNull()), unit, order, value, n, "__t", complete=False)
    size = F.size("__t")
    mean = F.when(size >= 2, (F.element_at("__t", -1) - F.element_at("__t", 1)) / (size - 1))
    return tails.select(*unit, F.element_at("__t", -1).alias("last_value"), mean.alias(name))


def roll_lags(lags: Column, newest: Column) -> Column:
    """Drop the oldest entry of an oldest-first lag array and append the newest."""
    return F.concat(F.slice(lags, F.lit(2), F.size(lags) - 1), F.array(newest))
