"""Suburb roll-up, min-max features, pillar scores, liveability and affordability."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from leasegrid import constants as C
from leasegrid.operators.joins import merge_on_combo
from leasegrid.operators.quantiles import exact_medians

MEAN_COLUMNS = (
    "rental_price",
    "bedrooms",
    "bathrooms",
    "car_spaces",
    "longitude",
    "latitude",
    "min_route_dist_m",
    "min_route_dur_s",
    "min_route_dist_m_imputed",
    "min_route_dur_s_imputed",
)
MEDIAN_COLUMNS = ("year", "quarter", "income_rent_ratio")
MODE_COLUMNS = ("property_type", "closest_ptv_station_id", "closest_ptv_station_id_imputed")


def modes_per_group(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Mode of many columns at once (ties to the smallest), via one long-form count."""
    numeric = {f.name for f in df.schema if isinstance(f.dataType, NumericType)}
    cell = F.array(
        *[
            F.struct(
                F.lit(c).alias("c"),
                (F.col(f"`{c}`").cast("double") if c in numeric else F.lit(None).cast("double")).alias("x"),
                (F.lit(None).cast("string") if c in numeric else F.col(f"`{c}`").cast("string")).alias("t"),
            )
            for c in columns
        ]
    )
    long = df.select(key, F.explode(cell).alias("v")).select(key, "v.c", "v.x", "v.t")
    long = long.where(F.col("x").isNotNull() | F.col("t").isNotNull())
    counts = long.groupBy(key, "c", "x", "t").agg(F.count("*").alias("n"))
    best = counts.groupBy(key, "c").agg(F.min(F.struct((-F.col("n")).alias("n"), "x", "t")).alias("b"))
    wide = best.groupBy(key).agg(
        *[F.max(F.when(F.col("c") == c, F.col("b.x" if c in numeric else "b.t"))).alias(c) for c in columns]
    )
    types = {f.name: f.dataType for f in df.schema}
    return wide.select(key, *[F.col(f"`{c}`").cast(types[c]).alias(c) for c in columns])


def suburb_rollup(df: DataFrame, key: str = "suburb") -> DataFrame:
    """One row per suburb by the prefix rules: mean, median, mode and sum columns."""
    have = [c for c in df.columns if c != key]
    summed = [c for c in have if c.startswith(("count_", "n_")) or c == "missing_iso_feature"]
    mean = [c for c in have if c in MEAN_COLUMNS or c.startswith("min_dist_")]
    mode = [c for c in have if c in MODE_COLUMNS or c.startswith("best_")]
    median = [c for c in have if c in MEDIAN_COLUMNS]
    df = df.where(F.col(key).isNotNull())
    out = df.groupBy(key).agg(
        F.count("*").alias("__n"),
        *[F.avg(f"`{c}`").alias(c) for c in mean],
        # pandas sums an all-missing group to 0
        *[F.coalesce(F.sum(f"`{c}`"), F.lit(0)).alias(c) for c in summed],
    )
    if mode:
        out = out.join(modes_per_group(df, key, mode), key, "left")
    if median:
        out = out.join(exact_medians(df, median, [key]), key, "left")
    return out.drop("__n")


# --- features and pillars ---------------------------------------------------------
# A score table has over a hundred features, so these expressions are SQL text:
# one parsed expression each instead of a dozen driver round trips.


def feature(columns: Collection[str], kind: str, base: str) -> str | None:
    """SQL of a raw feature before scaling; None when the table's ``columns`` lack it."""
    raw = f"CAST(`{base}` AS DOUBLE)" if base in columns else None
    both = [f"CAST(`{c}` AS DOUBLE)" for c in (base, base + "_imputed") if c in columns]
    filled = f"coalesce({', '.join(both)})" if both else None
    if kind == "count":
        return filled and f"coalesce({filled}, 0D)"
    if kind == "distance":
        return filled and f"IF({filled} IS NULL, NULL, 1D / (1D + greatest({filled}, 0D)))"
    if kind == "inverse":
        return raw and f"1D / nullif({raw}, 0D)"
    if kind == "direct":
        return raw
    raise ValueError(f"unknown feature kind {kind!r}")


def minmax(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add min-max scaled columns (name -> SQL); all ranges come from one aggregate.

    A (nearly) constant feature is 0.5 everywhere, an empty one NULL.
    """
    if not columns:
        return df
    staged = df.selectExpr("*", *[f"{sql} AS __x{i}" for i, sql in enumerate(columns.values())])
    ranges = ", ".join(f"'l{i}', min(__x{i}), 'h{i}', max(__x{i})" for i in range(len(columns)))
    bounds = staged.selectExpr(f"named_struct({ranges}) AS b").scalar()

    def unit(i: int) -> str:
        x, lo, hi = f"__x{i}", f"__b.l{i}", f"__b.h{i}"
        flat = f"abs({lo} - {hi}) <= 1e-8D + 1e-5D * abs({hi})"
        return f"CASE WHEN {flat} THEN 0.5D ELSE ({x} - {lo}) / ({hi} - {lo}) END"

    kept = [f"`{c}`" for c in df.columns]
    scaled = [f"{unit(i)} AS `{n}`" for i, n in enumerate(columns)]
    return staged.withColumn("__b", bounds).selectExpr(*kept, *scaled)


def mean_present(names: Sequence[str]) -> str:
    """SQL of the mean of the non-null columns; NULL when there are none."""
    cells = f"array_compact(array({', '.join(f'`{n}`' for n in names)}))"
    return f"IF(size({cells}) > 0, aggregate({cells}, 0D, (a, x) -> a + x) / size({cells}), NULL)"


def pillar_scores(
    df: DataFrame, pillars: Mapping[str, Mapping[str, Sequence[str]]] = C.PILLARS
) -> DataFrame:
    """Add pillar_<name>: the mean of its available scaled features."""
    have = set(df.columns)
    feats: dict[str, str] = {}
    members: dict[str, list[str]] = {}
    for pillar, config in pillars.items():
        members[pillar] = []
        for kind in ("count", "distance", "inverse", "direct"):
            for base in config.get(kind, ()):
                sql = feature(have, kind, base)
                if sql is not None:
                    name = f"__f{len(feats)}"
                    feats[name] = sql
                    members[pillar].append(name)
    means = [
        f"{mean_present(ns) if ns else 'CAST(NULL AS DOUBLE)'} AS `pillar_{p.lower()}`" for p, ns in members.items()
    ]
    kept = [f"`{c}`" for c in df.columns]
    return minmax(df, feats).selectExpr(*kept, *means)


def livability(df: DataFrame, weights: Mapping[str, float] = C.PILLAR_WEIGHTS, name: str = "livability_score") -> DataFrame:
    """Weighted sum of the pillars; NULL when any pillar is NULL."""
    total = F.lit(0.0)
    for pillar, w in weights.items():
        total = total + F.lit(w) * F.col(f"pillar_{pillar.lower()}")
    return df.withColumn(name, total)


def affordability(panel: DataFrame, rents: DataFrame, incomes: DataFrame, rent: str = "median_rent_census", income: str = "median_household_income", key: str = "suburb") -> DataFrame:
    """(suburb, rent, income, income_rent_ratio): rent divided by income, one row per suburb."""
    units = panel.select(key).where(F.col(key).isNotNull()).distinct()
    both = merge_on_combo(merge_on_combo(units, incomes, income, key), rents, rent, key)
    one = both.groupBy(key).agg(F.min(F.struct(rent, income)).alias("b")).select(key, "b.*")
    return one.withColumn("income_rent_ratio", F.try_divide(rent, income))
