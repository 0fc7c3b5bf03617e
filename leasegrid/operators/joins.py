"""Equi, semi, alias, combo-key and averaging joins.

No side is forced to broadcast: adaptive execution broadcasts a side only after
its real size is known, and splits skewed partitions otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leasegrid.functions.text import repair_suburb


def attach_features(df: DataFrame, key: str, *features: DataFrame) -> DataFrame:
    """Chain of left joins on one id."""
    return reduce(lambda a, f: a.join(f, key, "left"), features, df)


def outer_chain(keys: Sequence[str], *frames: DataFrame) -> DataFrame:
    """Chain of full outer joins; keys are coalesced."""
    return reduce(lambda a, f: a.join(f, list(keys), "full"), frames)


def geocoded(listings: DataFrame, geocodes: DataFrame, key: str = "property_id") -> DataFrame:
    """Listings with a successful geocode; the geocoder's own address copy is dropped."""
    ok = geocodes.where(F.col("geocode_success"))
    dup = [c for c in ok.columns if c in set(listings.columns) and c != key]
    return listings.join(ok.drop("geocode_success", *dup), key)


def semi(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return df.join(keys.select(key), key, "left_semi")


def alias_table(mapping: DataFrame, canonical: str = "canonical", aliases: str = "aliases") -> DataFrame:
    """Invert (canonical, ARRAY<alias>) to one row per alias; a repeated alias keeps the largest canonical."""
    pairs = mapping.select(F.explode(aliases).alias("alias"), F.col(canonical).alias("canonical"))
    return pairs.groupBy("alias").agg(F.max("canonical").alias("canonical"))


def map_aliases(df: DataFrame, column: str, aliases: DataFrame) -> DataFrame:
    """Lower-case ``column`` and replace known aliases; unknown names stay."""
    low = df.withColumn(column, F.lower(column))
    named = aliases.select(F.col("alias").alias(column), F.col("canonical").alias("__canon"))
    joined = low.join(named, column, "left")
    return joined.withColumn(column, F.coalesce("__canon", column)).select(*df.columns)


def combo_aliases(panel: DataFrame, localities: DataFrame, key: str = "suburb", name: str = "locality") -> DataFrame:
    """(canonical, aliases): panel names absent from the locality table, split on '-'."""
    unknown = (
        panel.select(F.lower(key).alias("canonical"))
        .distinct()
        .join(localities.select(F.lower(name).alias("canonical")), "canonical", "left_anti")
    )
    return unknown.withColumn("aliases", F.filter(F.split("canonical", "-"), lambda x: x != ""))


def merge_on_combo(
    destination: DataFrame, data: DataFrame, column: str, key: str = "suburb", repair: bool = True, units: DataFrame | None = None
) -> DataFrame:
    """Inner join on suburb, where a hyphenated destination key whose parts all exist
    in ``data`` receives the mean of all its parts' rows as an extra row.

    ``units`` may supply the destination's keys, so that chained merges do not
    read the growing destination twice each.
    """
    values = data.select(key, column)
    if repair:
        values = values.withColumn(key, repair_suburb(F.col(key)))
    values = values.where(F.col(key).isNotNull())
    parts = (
        (destination if units is None else units)
        .select(F.col(key).alias("__combo"))
        .where(F.contains(F.col("__combo"), F.lit("-")))
        .distinct()
        .select("__combo", F.array_distinct(F.split("__combo", "-")).alias("__parts"))
    )
    # Sum and count per part first: a hot part reaches the join as one row.
    per_part = values.groupBy(F.col(key).alias("__part")).agg(
        F.sum(column).alias("__s"), F.count(column).alias("__c")
    )
    averaged = (
        parts.select("__combo", F.size("__parts").alias("__need"), F.explode("__parts").alias("__part"))
        .join(per_part, "__part")
        .groupBy("__combo", "__need")
        .agg(F.count("*").alias("__found"), F.sum("__s").alias("__s"), F.sum("__c").alias("__c"))
        .where(F.col("__found") == F.col("__need"))
        .select(F.col("__combo").alias(key), F.try_divide("__s", "__c").alias(column))
    )
    combined = values.withColumn(column, F.col(column).cast("double")).unionByName(averaged)
    return destination.join(combined, key)


def suburbs_of_postcode(df: DataFrame, postcode: str) -> DataFrame:
    return df.where(F.col("postcode").cast("string") == str(postcode)).select("suburb")


def postcodes_of_suburb(df: DataFrame, suburb: str) -> DataFrame:
    return df.where(F.lower("suburb") == suburb.lower()).select("postcode")


def bind_columns(a: DataFrame, b: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Column bind by explicit key instead of row position."""
    return a.join(b, [key] if isinstance(key, str) else list(key))


def with_global(df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """Attach global aggregates of ``df`` to every row as one scalar subquery."""
    one = df.agg(F.struct(*[c.alias(n) for n, c in values.items()]).alias("__g")).scalar()
    out = df.withColumn("__g", one)
    return out.select(*df.columns, *[F.col("__g")[n].alias(n) for n in values])


def spatial_lag(
    panel: DataFrame,
    edges: DataFrame,
    time: str,
    value: str,
    unit: str = "suburb",
    name: str = "spatial_lag",
    renormalise: bool = True,
) -> DataFrame:
    """Weighted mean of the neighbours' mean value at the same time; 0 without neighbours.

    ``renormalise`` divides by the weights of the neighbours present.
    """
    means = panel.groupBy(F.col(unit).alias("dst"), time).agg(F.avg(value).alias("__m"))
    means = means.where(F.col("__m").isNotNull())
    wsum = F.sum(F.col("w") * F.col("__m"))
    lag = wsum / F.sum("w") if renormalise else wsum
    lags = (
        edges.where(F.col("w") > 0)
        .join(means, "dst")
        .groupBy(F.col("src").alias(unit), time)
        .agg(lag.alias(name))
    )
    return panel.join(lags, [unit, time], "left").withColumn(name, F.coalesce(name, F.lit(0.0)))
