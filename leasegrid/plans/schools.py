"""Schools: dedup and rank, then best school per listing and travel band."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leasegrid import constants as C
from leasegrid.functions.geo import wkt_shape
from leasegrid.functions.numbers import school_goodness
from leasegrid.operators import clean
from leasegrid.operators.match import fuzzy_dedup, rank_schools
from leasegrid.operators.spatial import best_schools
from leasegrid.session import cut_lineage


def process_schools(schools: DataFrame, order: Sequence[str] = ("establishment_year", "School_No"), threshold: float = 0.99) -> DataFrame:
    """Open, non-camp, non-language schools without near-duplicates or repeated names."""
    cols = ["School_Name", "Education_Sector", "School_Type", "School_Status", "establishment_year", "X", "Y"]
    df = schools.select(*cols, *[F.col(c).alias(f"__ord{i}") for i, c in enumerate(order)])
    df = df.withColumns({c: F.col(c).cast("string").try_cast("double") for c in ("X", "Y")})
    df = df.withColumns({"lon": F.col("X"), "lat": F.col("Y"), "X": F.round("X", 1), "Y": F.round("Y", 1)})
    ords = [f"__ord{i}" for i in range(len(order))]
    df = cut_lineage(fuzzy_dedup(cut_lineage(df), "School_Name", ["X", "Y"], ords, threshold))
    df = clean.drop_listed(df, "School_Type", ["Language", "Camp"])
    df = df.where(~F.col("School_Status").eqNullSafe("C")).drop("School_Status")
    df = clean.snake_names(df)
    group = ["education_sector", "school_type", "establishment_year"]
    return clean.drop_repeated_names(df, "school_name", group, ords).drop(*ords)


def ranked(schools: DataFrame, ranks: DataFrame, cutoff: float = 0.85) -> DataFrame:
    out = rank_schools(schools, ranks, cutoff)
    return out.withColumn("school_goodness", school_goodness(F.col("vic_secondary_rank")))


def attach_best_schools(listings: DataFrame, schools: DataFrame, bands: Sequence[str], method: str = "geodesic") -> DataFrame:
    """Wide best_* and n_schools_* columns per WKT band column; all bands share one join."""
    rings = F.array(*[F.struct(F.lit(b).alias("band"), F.col(f"`{b}`").alias("wkt")) for b in bands])
    long = listings.select(
        "property_id", "year", F.col("lat").alias("listing_lat"), F.col("lon").alias("listing_lon"), F.explode(rings).alias("b")
    ).select("property_id", "year", "listing_lat", "listing_lon", "b.band", wkt_shape(F.col("b.wkt")).alias("ring"))
    best = best_schools(long, schools, method=method)
    fields = [*C.SCHOOL_FIELDS, "n_schools"]
    wide = best.groupBy("property_id").agg(
        *[F.max(F.when(F.col("band") == b, F.col(f))).alias(f"{f}_{b}") for b in bands for f in fields]
    )
    return listings.join(wide, "property_id", "left")


def fill_from_fallback(
    df: DataFrame,
    targets: Sequence[str] = tuple(C.SCHOOL_TARGETS),
    fallback: Mapping[str, Sequence[str]] = C.SCHOOL_FALLBACK,
    fields: Sequence[str] = tuple(C.SCHOOL_FIELDS),
    count: str = "n_schools",
) -> DataFrame:
    """A band without any school field copies all fields from the first band that has them all.

    Availability is judged on the original columns; the count is copied only
    when the target's own count is 0 or NULL.
    """
    have = set(df.columns)
    bands = {*targets, *(b for t in targets for b in fallback[t])}
    cols = {b: [f"{f}_{b}" for f in fields if f"{f}_{b}" in have] for b in bands}

    def all_of(names, test):
        out = F.lit(bool(names))
        for n in names:
            out = out & test(F.col(n))
        return out

    avail = {b: all_of(cols[b], lambda c: c.isNotNull()) for b in bands}
    new = {}
    for t in targets:
        if not cols[t]:
            continue
        missing = all_of(cols[t], lambda c: c.isNull())
        sources = [b for b in fallback[t] if cols[b]]
        for f in [*fields, count]:
            name = f"{f}_{t}"
            if name not in have:
                continue
            gate = missing & (F.coalesce(F.col(name), F.lit(0)) == 0) if f == count else missing
            value = None
            for b in sources:
                if f"{f}_{b}" not in have:
                    continue
                value = (F if value is None else value).when(avail[b], F.col(f"{f}_{b}"))
            if value is not None:
                usable = F.lit(False)
                for b in sources:
                    usable = usable | avail[b]
                new[name] = F.when(gate & usable, value).otherwise(F.col(name))
    return df.withColumns(new)


def finalise(df: DataFrame) -> DataFrame:
    """Remaining gaps: a tiny score, the longest distance + 1 (1.0 when none), zero counts."""
    scores = [c for c in df.columns if c.startswith("best_score_")]
    dists = [c for c in df.columns if c.startswith("best_dist_km_")]
    counts = [c for c in df.columns if c.startswith("n_schools_")]
    fills = {c: F.coalesce(F.col(c), F.lit(C.MISSING_SCHOOL_SCORE)) for c in scores}
    fills |= {c: F.coalesce(F.col(c), F.lit(0)) for c in counts}
    if dists:
        top = df.agg(F.struct(*[F.max(c).alias(c) for c in dists]).alias("m")).scalar()
        df = df.withColumn("__m", top)
        fills |= {c: F.coalesce(F.col(c), F.col(f"__m.{c}") + 1, F.lit(1.0)) for c in dists}
    return df.withColumns(fills).drop("__m")


def school_features(listings: DataFrame, schools: DataFrame, ranks: DataFrame, bands: Sequence[str]) -> DataFrame:
    """Complete workflow from raw school rows to finished listing features."""
    good = cut_lineage(ranked(process_schools(schools), ranks))
    best = cut_lineage(attach_best_schools(listings, good, bands))
    return finalise(fill_from_fallback(best))
