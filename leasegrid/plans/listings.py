"""Listings: clean live and archive rows, combine, cut outliers, sample, enrich."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leasegrid import constants as C
from leasegrid.functions.dates import mixed_timestamp
from leasegrid.functions.text import property_category, property_features, slug_address, weekly_rent
from leasegrid.operators import clean, joins
from leasegrid.operators.spatial import nearest_gifts
from leasegrid.session import cut_lineage

ROOMS = ["bedrooms", "bathrooms", "car_spaces"]
LIVE_COLUMNS = [
    "property_id", "rental_price", "suburb", "postcode", "property_type", "year", "quarter",
    "bedrooms", "bathrooms", "car_spaces", "age_0_to_19", "age_20_to_39", "age_40_to_59", "age_60_plus",
    "agency_name", "appointment_only", "avg_days_on_market", "description", "family_percentage",
    "first_listed_date", "latitude", "longitude", "listing_status", "long_term_resident",
    "median_rent_price", "median_sold_price", "number_sold", "renter_percentage", "single_percentage",
]


def clean_live(df: DataFrame, aliases: DataFrame | None = None, more_than: int = 10, strict_keys: bool = False) -> DataFrame:
    """Live listing rows to typed, standardised, imputed rows with a weekly rent."""
    df = clean.snake_names(df)
    df = clean.drop_nulls(df, ["property_id", "property_features", "description"])
    df = df.withColumn("property_id", F.col("property_id").cast("string").try_cast("double").cast("long"))
    df = clean.drop_present(df, [*ROOMS, "land_area"])
    df = clean.keep_listed(df.withColumn("property_type", F.lower("property_type")), "property_type", C.PERMITTED_TYPES)
    df = df.withColumn("house_flat_other", property_category(F.col("property_type"), strict_keys))
    df = joins.map_aliases(df, "suburb", aliases) if aliases is not None else df.withColumn("suburb", F.lower("suburb"))
    df = clean.keep_large_groups(df, "suburb", more_than)
    parsed = df.withColumn("__f", property_features(F.col("property_features")))
    df = parsed.select(*df.columns, *[F.col(f"__f.{c}").alias(c) for c in ROOMS])
    df = clean.impute_modes(cut_lineage(df), ROOMS, "property_type")
    if "appointment_only" in df.columns:
        df = clean.impute_overall_mode(df, "appointment_only")
    dates = {c: mixed_timestamp(F.col(c).cast("string")) for c in ("updated_date", "first_listed_date", "last_sold_date") if c in df.columns}
    df = df.withColumns(dates)
    df = df.withColumns({"year": F.year("updated_date"), "quarter": F.quarter("updated_date")})
    return df.withColumn("rental_price", weekly_rent(F.col("rental_price"))).where(F.col("rental_price").isNotNull())


def finish_live(df: DataFrame) -> DataFrame:
    """Relevant columns only, rows without NULLs."""
    return clean.drop_nulls(clean.select_present(df, LIVE_COLUMNS))


def clean_archive(
    df: DataFrame, aliases: DataFrame | None = None, more_than: int = 10, tie: Sequence[Column | str] = ("wayback_time", "url")
) -> DataFrame:
    """Archive rows (with year and quarter) to the latest complete row per property."""
    df = joins.map_aliases(df, "suburb", aliases) if aliases is not None else df.withColumn("suburb", F.lower("suburb"))
    df = clean.keep_large_groups(df, "suburb", more_than).drop("land_area")
    df = df.withColumns({c: F.col(c).cast("string").try_cast("double").cast("int") for c in ROOMS})
    df = clean.impute_modes(cut_lineage(df), ROOMS, "property_type")
    df = df.withColumn("rental_price", weekly_rent(F.col("rental_price"))).where(F.col("rental_price").isNotNull())
    df = clean.keep_latest(df, "property_id", ["year", "quarter", *tie])
    df = df.withColumn("address", slug_address(F.col("url")))
    unused = ["url", "property_features", "postcode", "scraped_date", "wayback_url", "wayback_time"]
    return clean.drop_nulls(clean.drop_present(df, unused))


def combine(live: DataFrame, archive: DataFrame, geocodes: DataFrame | None = None) -> DataFrame:
    """Union over common columns, latest row per property, outliers cut in turn."""
    if geocodes is not None:
        archive = joins.geocoded(archive, geocodes)
    both = clean.union_common(
        live.withColumn("source", F.lit("live")), archive.withColumn("source", F.lit("wayback"))
    )
    latest = clean.keep_latest(both, "property_id", ["year", "quarter", "source", "rental_price"])
    return clean.clip_quantiles_in_turn(cut_lineage(latest), "rental_price")


def sample(df: DataFrame, fraction: float = 0.5) -> DataFrame:
    return clean.stratified_sample(df, ["property_type", "suburb", "bedrooms"], "property_id", fraction)


def enrich(listings: DataFrame, pois: DataFrame, routes: DataFrame, isochrones: Sequence[DataFrame] = ()) -> DataFrame:
    """Attach POI, route and isochrone features and fill their gaps from neighbours.

    ``listings`` carries lat/lon. Columns with gaps get an ``_imputed`` twin;
    POI counts with gaps are 0-filled and renamed instead.
    """
    dense = clean.drop_sparse_columns(pois)
    full = clean.fill_counts(joins.attach_features(listings, "property_id", dense))
    groups = [[c] for c in dense.columns if c.startswith("min_dist_")]
    full = joins.attach_features(full, "property_id", routes.withColumnRenamed("stationid", "closest_ptv_station_id"))
    groups += [["closest_ptv_station_id"], ["min_route_dist_m"], ["min_route_dur_s"]]
    for iso in isochrones:
        full = joins.attach_features(full, "property_id", iso)
        groups.append([c for c in iso.columns if c != "property_id"])
    # Every group of columns is filled from the same frozen rows, so the work
    # grows with the number of groups, not with its square.
    full = cut_lineage(full)
    out = joins.attach_features(full, "property_id", *[nearest_gifts(full, g, "property_id") for g in groups])
    names = [c for g in groups for c in g]
    filled = {f"{c}_imputed": F.coalesce(F.col(c), F.col(f"__g_{c}")) for c in names}
    return out.withColumns(filled).drop(*[f"__g_{c}" for c in names])
