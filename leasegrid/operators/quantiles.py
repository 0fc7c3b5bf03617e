"""Exact linear-interpolation quantiles of many columns at once, never gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leasegrid.operators.ordering import running_totals
from leasegrid.session import cut_lineage

_INF = float("inf")


def long_values(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Frozen rows ``(by, column, value)`` of all columns from one scan; missing values and null groups are left out."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("value")) for c in columns])
    rows = df.select(*by, F.explode(cells).alias("__c")).select(*by, "__c.column", "__c.value")
    known = F.col("value").isNotNull() & ~F.isnan("value")
    for k in by:
        known = known & F.col(k).isNotNull()
    return cut_lineage(rows.where(known))


def quantiles_of(
    values: DataFrame, probabilities: Sequence[float], by: Sequence[str] = (), names: Sequence[str] | None = None, accuracy: int = 10000
) -> DataFrame:
    """(by, column, exact quantiles) of the rows of ``long_values``.

    1. One quantile sketch per group and column brackets every requested rank
       (rank error <= n/accuracy).
    2. Values outside the brackets collapse to one counted row per gap; values
       inside collapse to one counted row per distinct value (map-side). Below
       ``accuracy`` rows a sketch is no shorter than the group, so all is inside.
    3. Running counts over that small table place the two neighbouring order
       statistics of each rank, and the result is interpolated.
    """
    names = list(names or [f"q{int(round(p * 100))}" for p in probabilities])
    by = [*by, "column"]
    v = F.col("value")
    margin = 3.0 / accuracy
    lows = [max(p - margin, 0.0) for p in probabilities]
    highs = [min(p + margin, 1.0) for p in probabilities]
    sketch = F.struct(F.percentile_approx("value", [*lows, *highs], accuracy).alias("g"), F.count("*").alias("n"))
    # Only groups longer than ``accuracy`` need brackets: at most a row per so many
    # values, which goes to the rows. By key all values of one group would go to one task.
    long = values.groupBy(*by).agg(sketch.alias("__s")).where(F.col("__s.n") > accuracy)
    marked = values.join(F.broadcast(long), by, "left")
    m = len(names)
    lo = [F.lit(-_INF) if p == 0.0 else F.col("__s.g")[i] for i, p in enumerate(lows)]
    hi = [F.lit(_INF) if p == 1.0 else F.col("__s.g")[m + i] for i, p in enumerate(highs)]
    inside = F.col("__s").isNull()
    gap = F.lit(-_INF)
    for a, b in zip(lo, hi):
        inside = inside | v.between(a, b)
        gap = F.greatest(gap, F.when(b < v, b).otherwise(F.lit(-_INF)))
    slots = marked.select(*by, F.when(inside, v).otherwise(gap).alias("__k"), F.when(inside, 0).otherwise(1).alias("__c"))
    reduced = slots.groupBy(*by, "__k", "__c").agg(F.count("*").alias("__n"))

    ranked = running_totals(reduced, ["__k", "__c"], "__n", by, "__cum", total="__total")
    first, after = F.col("__cum") - F.col("__n"), F.col("__cum")
    aggs = []
    for i, p in enumerate(probabilities):
        at = F.lit(float(p)) * (F.col("__total") - 1)
        floor, ceil = F.floor(at), F.ceil(at)
        aggs += [
            F.max(F.when((first <= floor) & (floor < after), F.col("__k"))).alias(f"__lo{i}"),
            F.max(F.when((first <= ceil) & (ceil < after), F.col("__k"))).alias(f"__hi{i}"),
        ]
    found = ranked.groupBy(*by).agg(F.max("__total").alias("__total"), *aggs)
    out = []
    for i, (p, name) in enumerate(zip(probabilities, names)):
        at = F.lit(float(p)) * (F.col("__total") - 1)
        a, b = F.col(f"__lo{i}"), F.col(f"__hi{i}")
        out.append((a + (b - a) * (at - F.floor(at))).alias(name))
    return found.select(*by, *out)


def exact_quantiles(
    df: DataFrame,
    value: str,
    probabilities: Sequence[float],
    by: Sequence[str] = (),
    names: Sequence[str] | None = None,
    accuracy: int = 10000,
) -> DataFrame:
    """One row per group with the exact quantiles of one column."""
    return quantiles_of(long_values(df, [value], by), probabilities, by, names, accuracy).drop("column")


def exact_median(df: DataFrame, value: str, by: Sequence[str] = (), name: str = "median") -> DataFrame:
    return exact_quantiles(df, value, [0.5], by, [name])


def exact_medians(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """One row per group with the exact median of every column, under the column's name."""
    found = quantiles_of(long_values(df, columns, by), [0.5], by, ["__m"])
    return found.groupBy(*by).agg(*[F.max(F.when(F.col("column") == c, F.col("__m"))).alias(c) for c in columns])
