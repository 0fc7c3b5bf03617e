"""Counts, data quality, descriptive statistics and tests."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from leasegrid.functions.numbers import normal_quantile
from leasegrid.operators.ordering import row_numbers, running_totals
from leasegrid.operators.quantiles import long_values, quantiles_of


def value_counts(df: DataFrame, column: str, name: str = "n", share: str | None = None) -> DataFrame:
    """Non-null value counts, optionally with each value's share of the total."""
    known = df.where(F.col(column).isNotNull())
    out = known.groupBy(column).agg(F.count("*").alias(name))
    if share:
        total = known.agg(F.count("*").alias("t")).scalar()
        out = out.withColumn(share, F.col(name) / total)
    return out


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """One row of distinct non-null counts."""
    if approximate:
        return df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
    return df.agg(*[F.count_distinct(c).alias(c) for c in columns])


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, nulls, null_share) of every column, in one pass."""
    columns = list(columns or df.columns)
    counts = df.agg(F.count("*").alias("__n"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("nulls")) for c in columns])
    long = counts.select("__n", F.explode(pairs).alias("p"))
    return long.select("p.column_name", "p.nulls", F.try_divide("p.nulls", "__n").alias("null_share"))


def quality_counts(df: DataFrame, column: str, ceiling: float = 5000) -> DataFrame:
    c = F.col(column)
    return df.agg(
        F.count_if(c < 0).alias("negative"), F.count_if(c == 0).alias("zero"), F.count_if(c > ceiling).alias("above_ceiling")
    )


def describe_columns(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, column, count, mean, std (n-1), min, quartiles, max) of every column, from one scan."""
    values = long_values(df, columns, by)
    keys = [*by, "column"]
    moments = values.groupBy(*keys).agg(
        F.count("*").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = quantiles_of(values, [0.25, 0.5, 0.75], by, ["q25", "median", "q75"])
    return moments.join(quartiles, keys)


def describe(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """count, mean, std (n-1), min, quartiles, max of one column, per group."""
    kind = df.schema[value].dataType
    out = describe_columns(df, [value], by).withColumns({c: F.col(c).cast(kind) for c in ("min", "max")})
    if by:
        every = df.select(*by).distinct()
        out = every.join(out, list(by), "left").withColumn("count", F.coalesce("count", F.lit(0)))
    return out.drop("column")


def residual_summary(df: DataFrame, actual: str, predicted: str, by: str = "split") -> DataFrame:
    """mean, std, mean absolute value and median of the residual per group, from one scan."""
    values = long_values(df.select(by, (F.col(actual) - F.col(predicted)).alias("residual")), ["residual"], [by])
    moments = values.groupBy(by).agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.avg(F.abs("value")).alias("mean_abs")
    )
    return moments.join(quantiles_of(values, [0.5], [by], ["median"]).drop("column"), by)


def snapshot_totals(df: DataFrame, key: str, stamp: str) -> DataFrame:
    """Totals by year, by month, by key and overall, in one grouping-sets pass."""
    base = df.select(F.year(stamp).alias("year"), F.month(stamp).alias("month"), key)
    sets = [[F.col("year")], [F.col("month")], [F.col(key)], []]
    return base.groupingSets(sets, "year", "month", key).agg(F.count("*").alias("snapshots"))


def mean_per_key(df: DataFrame, key: str) -> DataFrame:
    """Average number of rows per key."""
    return df.agg((F.count(key) / F.count_distinct(key)).alias("mean_per_key"))


def success_rate(df: DataFrame, flag: str) -> DataFrame:
    return df.agg(F.avg(F.col(flag).cast("double")).alias("success_rate"))


def threshold_counts(df: DataFrame, column: str, low: float = 50, high: float = 100, top: float = 200) -> DataFrame:
    c = F.col(column)
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(c > 0).alias("positive"),
        F.count_if(c < 0).alias("negative"),
        F.count_if(c > top).alias("very_high"),
        F.count_if(c > high).alias("high"),
        F.count_if((c > low) & (c <= high)).alias("medium"),
        F.count_if(c <= low).alias("low"),
    )


def size_class(n: Column) -> Column:
    return F.when(n <= 3, "small").when(n <= 5, "medium").otherwise("large")


# --- distributions -------------------------------------------------------------


def empirical_cdf(df: DataFrame, value: str, name: str = "ecdf") -> DataFrame:
    """(value, n, ecdf): counted per distinct value, then a split running total."""
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("n"))
    run = running_totals(counts, [value], "n", name="__c", total="__t")
    return run.select(value, "n", (F.col("__c") / F.col("__t")).alias(name))


def histogram(df: DataFrame, value: str, bins: int = 10) -> DataFrame:
    """(bin, low, high, n) over equal-width bins; the last bin is closed."""
    v = F.col(value)
    box = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi")).alias("b")).scalar()
    binned = df.where(v.isNotNull()).withColumn("__b", box)
    width = (F.col("__b.hi") - F.col("__b.lo")) / bins
    slot = F.coalesce(F.floor(F.try_divide(v - F.col("__b.lo"), width)), F.lit(0))
    binned = binned.select(F.least(slot, F.lit(bins - 1)).cast("int").alias("bin"), "__b")
    counts = binned.groupBy("bin").agg(F.count("*").alias("n"), F.first("__b").alias("__b"))
    low = F.col("__b.lo") + F.col("bin") * width
    return counts.select("bin", low.alias("low"), (low + width).alias("high"), "n")


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, corr) for every column pair, in one pass."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    row = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    items = F.array(
        *[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("corr")) for i, (a, b) in enumerate(pairs)]
    )
    return row.select(F.explode(items).alias("p")).select("p.a", "p.b", "p.corr")


def shape(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Population skewness and excess kurtosis."""
    aggs = [F.skewness(value).alias("skewness"), F.kurtosis(value).alias("kurtosis")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def line_fit(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Degree-1 least squares: slope and intercept of y on x."""
    aggs = [F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def normal_qq(df: DataFrame, value: str, tie: Sequence[str]) -> DataFrame:
    """(theoretical, ordered) points with Filliben plotting positions."""
    known = df.where(F.col(value).isNotNull()).select(value, *tie)
    ranked = row_numbers(known, [value, *tie], "i")
    n = known.agg(F.count("*").alias("n")).scalar()
    i, size = F.col("i"), F.col("__n")
    end = F.pow(F.lit(0.5), 1 / size)
    p = F.when(i == size, end).when(i == 1, 1 - end).otherwise((i - 0.3175) / (size + 0.365))
    points = ranked.withColumn("__n", n).withColumn("p", p)
    return points.select(*tie, "i", normal_quantile(F.col("p")).alias("theoretical"), F.col(value).alias("ordered"))


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 500):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + num * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + num / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return h


def _f_tail(f: float, d1: float, d2: float) -> float:
    """P(F >= f); the F survival function through the incomplete beta."""
    if not (f >= 0) or d1 <= 0 or d2 <= 0:
        return math.nan
    x, a, b = d2 / (d2 + d1 * f), d2 / 2, d1 / 2
    if x in (0.0, 1.0):
        return x
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1 - x) / b


@F.pandas_udf(DoubleType())
def f_survival(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return pd.Series([_f_tail(*v) for v in zip(f, d1, d2)], dtype=float)


def anova(df: DataFrame, value: str, group: str) -> DataFrame:
    """One-way ANOVA: F statistic, degrees of freedom and p-value (one row)."""
    per = df.where(F.col(value).isNotNull() & F.col(group).isNotNull()).groupBy(group).agg(
        F.count(value).cast("double").alias("n"), F.avg(value).alias("m"), F.var_pop(value).alias("v")
    )
    sums = per.agg(
        F.count("*").alias("k"),
        F.sum("n").alias("n"),
        (F.sum(F.col("n") * F.col("m") * F.col("m")) - F.sum(F.col("n") * F.col("m")) * F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("between"),
        F.sum(F.col("n") * F.col("v")).alias("within"),
    )
    d1, d2 = (F.col("k") - 1).cast("double"), F.col("n") - F.col("k")
    stat = F.try_divide(F.col("between") / d1, F.col("within") / d2)
    out = sums.select(stat.alias("f_stat"), d1.alias("df_between"), d2.alias("df_within"))
    return out.withColumn("p_value", f_survival("f_stat", "df_between", "df_within"))


def grouped_means(df: DataFrame, keys: Sequence[str], values: Mapping[str, str]) -> DataFrame:
    """Mean of each column per key; ``values`` maps column -> output name."""
    return df.groupBy(*keys).agg(*[F.avg(c).alias(n) for c, n in values.items()])
