"""Neighbour, radius and polygon joins by adaptive tiles, and spatial weights.

Coordinates are two named doubles. Tiles form a binary hierarchy over the data
extent: level 0 is one tile, each level halves the side. Every distance join is
an equi-join on tile keys; identical coordinates are collapsed before the join
and expanded after it, so copies cost one search.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from leasegrid.functions.geo import distance_km, edges_cover, shape_edges
from leasegrid.functions.numbers import distance_decay
from leasegrid.operators.pyramid import DEEPEST, at_levels, block, counted, disc_tiles, levels_in, metric, reach, shared_nearest_tiles, tiling, up
from leasegrid.session import cut_lineage, exchanged


def nearest(
    points: DataFrame,
    sites: DataFrame,
    k: int,
    point_id: str,
    site_id: str,
    by: Sequence[str] = (),
    within: float | None = None,
    method: str = "haversine",
    lat: str = "lat",
    lon: str = "lon",
    exclude_self: bool = False,
) -> DataFrame:
    """Exact k nearest sites per point: (point_id, site_id, distance, rank).

    Each point starts with the 3x3 block at the deepest level whose block is
    sure to hold its k nearest: its own finer tile already holds k sites, and the
    block reaches past that tile's diagonal; without such a tile the block is
    everything. Points of one tile search together. Where their block has many
    more sites than k, both they and the sites descend the pyramid, so far
    points and uneven densities meet about k candidates too. ``within`` (km;
    degrees when planar) caps the distance. ``by`` restricts neighbours to the
    same group. ``method='geodesic'`` measures on WGS84. Ties go to the smaller
    site id.
    """
    by = list(by)
    want = k + 1 if exclude_self else k
    flat = "haversine" if method == "geodesic" else method
    here = [F.col(c) for c in by]
    placed = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    for c in here:
        placed = placed & c.isNotNull()
    points = points.where(placed).select(F.col(point_id).alias("__pid"), *by, F.col(lat).alias("__lat"), F.col(lon).alias("__lon"))
    sites = sites.where(placed).select(F.col(site_id).alias("__sid"), *by, F.col(lat).alias("__slat"), F.col(lon).alias("__slon"))
    grid = tiling([(points, "__lat", "__lon"), (sites, "__slat", "__slon")], flat)

    # At most ``want`` sites matter per coordinate; the rank filter is pushed
    # below the shuffle, so a pile of copies leaves each task as ``want`` rows.
    same = Window.partitionBy(*by, "__slat", "__slon").orderBy("__sid")
    sites = sites.withColumn("__r", F.row_number().over(same)).where(F.col("__r") <= want).drop("__r")
    sites = sites.withColumn("__fx", grid.cell("x", F.col("__slon"))).withColumn("__fy", grid.cell("y", F.col("__slat")))
    spots = points.select(*by, "__lat", "__lon").distinct()
    spots = spots.withColumn("__fx", grid.cell("x", F.col("__lon"))).withColumn("__fy", grid.cell("y", F.col("__lat")))

    floor = 0 if within is None else grid.level_reaching(reach(method, within))
    first = max(floor, grid.shallowest())
    tile = [*by, "__l", "__tx", "__ty"]
    cells = cut_lineage(sites.groupBy(*by, "__fx", "__fy").agg(F.count("*").alias("__n")))
    levels = range(min(first + grid.shift, DEEPEST), DEEPEST + 1)
    full = cut_lineage(counted(cells, levels, by).where(F.col("__n") >= want).select(*tile))
    used = levels_in(full) or [0]
    # places of one tile at the finest such level start alike
    rest = 2 ** (DEEPEST - used[-1])
    corner = [(F.col(f) - F.pmod(F.col(f), F.lit(rest))).alias(c) for f, c in (("__fx", "__cx"), ("__fy", "__cy"))]
    asking = spots.select(*by, *corner).distinct().withColumnsRenamed({"__cx": "__fx", "__cy": "__fy"})
    depth = at_levels(asking, used).join(exchanged(full), tile).groupBy(*by, "__fx", "__fy").agg(F.max("__l").alias("__deep"))
    level = F.coalesce(F.col("__deep") - grid.shift, F.lit(floor)).cast("int")
    start = asking.join(exchanged(depth), [*by, "__fx", "__fy"], "left").select(*by, F.col("__fx").alias("__cx"), F.col("__fy").alias("__cy"), level.alias("__s"))
    spots = cut_lineage(spots.select("*", *corner).join(exchanged(start), [*by, "__cx", "__cy"]).drop("__cx", "__cy"))
    tiles = cut_lineage(shared_nearest_tiles(spots, cells, grid, method, want, within, by, leaf=64 + 20 * want))

    # Places of one asking tile meet the same sites; those beyond the tile's bound are not ranked.
    asker = [*by, "__s", "__l", "__gx", "__gy"]
    used = levels_in(tiles) or [0]
    offered = at_levels(sites, used).select(*tile, "__sid", "__slat", "__slon")
    offered = tiles.join(exchanged(offered), tile).select(*asker, "__limit", "__sid", "__slat", "__slon")
    asked = at_levels(spots, used).withColumnsRenamed({"__tx": "__gx", "__ty": "__gy"}).select(*asker, "__lat", "__lon")
    gap = metric(method, F.col("__lat"), F.col("__lon"), F.col("__slat"), F.col("__slon"))
    pairs = asked.join(exchanged(offered), asker).select(*by, "__lat", "__lon", "__sid", "__limit", gap.alias("distance"))
    pairs = pairs.where(F.col("__limit").isNull() | (F.col("distance") <= F.col("__limit") * (1 + 1e-9))).drop("__limit")
    if within is not None:
        pairs = pairs.where(F.col("distance") <= within)
    order = Window.partitionBy(*by, "__lat", "__lon").orderBy("distance", "__sid")
    best = pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= want)

    spot = [*by, "__lat", "__lon"]
    out = points.join(exchanged(best), spot)
    if exclude_self:
        again = Window.partitionBy("__pid").orderBy("distance", "__sid")
        out = (
            out.where(F.col("__pid") != F.col("__sid"))
            .withColumn("rank", F.row_number().over(again))
            .where(F.col("rank") <= k)
        )
    return out.select(F.col("__pid").alias(point_id), F.col("__sid").alias("neighbour" if site_id == point_id else site_id), "distance", "rank")


def cheapest_candidate(candidates: DataFrame, key: str, cost: str, tie: str) -> DataFrame:
    """The candidate with the lowest cost per key."""
    rest = [c for c in candidates.columns if c != key]
    pick = F.min_by(F.struct(*rest), F.struct(cost, tie))
    out = candidates.where(F.col(cost).isNotNull()).groupBy(key).agg(pick.alias("__b"))
    return out.select(key, *[F.col("__b")[c].alias(c) for c in rest])


#: Tiles are at least a radius over this long: few pairs outside the disc are measured.
_TILES_PER_RADIUS = 4


def within_radius(
    points: DataFrame,
    sites: DataFrame,
    radius_km: float,
    method: str = "haversine",
    lat: str = "lat",
    lon: str = "lon",
) -> DataFrame:
    """Every (point, site) pair within the radius, with ``distance`` in km.

    Site columns are kept except lat/lon, which come back as site_lat/site_lon.
    ``method='geodesic'`` filters by the tile block and measures on WGS84.
    """
    flat = "haversine" if method == "geodesic" else method
    placed = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    points, sites = points.where(placed), sites.where(placed)
    sites = sites.withColumnsRenamed({lat: "site_lat", lon: "site_lon"})
    grid = tiling([(points, lat, lon), (sites, "site_lat", "site_lon")], flat)
    span = reach(method, radius_km)
    deep = grid.level_reaching(span / _TILES_PER_RADIUS)
    level = F.lit(deep)
    left = points.withColumn("__tx", up(grid.cell("x", F.col(lon)), level)).withColumn("__ty", up(grid.cell("y", F.col(lat)), level))
    right = block(sites, up(grid.cell("x", F.col("site_lon")), level), up(grid.cell("y", F.col("site_lat")), level), grid.steps_reaching(span, deep))
    # few bytes make many pairs, so the tasks are not put together by bytes
    spread = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left, right = (side.repartition(spread, "__tx", "__ty") for side in (left, right))
    gap = metric(method, F.col(lat), F.col(lon), F.col("site_lat"), F.col("site_lon"))
    return (
        left.join(exchanged(right), ["__tx", "__ty"])
        .withColumn("distance", gap)
        .where(F.col("distance") <= radius_km)
        .drop("__tx", "__ty")
    )


def amenity_summary(pairs: DataFrame, key: str, amenity: str, amenities: Sequence[str], distance: str = "distance", name: str = "name", scale: float = 1000.0) -> DataFrame:
    """count_<amenity> (0 when none) and min_dist_<amenity> (metres, NULL when none) per key."""
    aggs = []
    for a in amenities:
        hit = F.col(amenity) == a
        aggs.append(F.count(F.when(hit, F.col(name))).alias(f"count_{a}"))
        aggs.append(F.min(F.when(hit, F.col(distance) * scale)).alias(f"min_dist_{a}"))
    return pairs.groupBy(key).agg(*aggs)


def amenities_near(
    listings: DataFrame,
    pois: DataFrame,
    key: str,
    tags: str,
    amenities: Sequence[str],
    radius_km: float = 2.0,
    method: str = "geodesic",
) -> DataFrame:
    """count_<amenity> and min_dist_<amenity> (metres) within the radius, computed once per distinct coordinate.

    No pair is listed for the summary. Places of one tile search together: tiles
    wholly inside all their discs add their counts, only sites in small tiles
    across a rim are measured, and the least distance comes from a search for
    the one nearest site per amenity.
    """
    flat = "haversine" if method == "geodesic" else method
    placed = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    spots = listings.where(placed).select(F.col("lat").alias("__lat"), F.col("lon").alias("__lon")).distinct()
    sites = pois.where(placed & F.col("amenity").rlike(tags)).select("amenity", "name", F.col("lat").alias("__slat"), F.col("lon").alias("__slon"))
    grid = tiling([(spots, "__lat", "__lon"), (sites, "__slat", "__slon")], flat)
    sites = sites.withColumn("__fx", grid.cell("x", F.col("__slon"))).withColumn("__fy", grid.cell("y", F.col("__slat")))
    # copies of a place count together
    spot_sites = cut_lineage(sites.groupBy("amenity", "__slat", "__slon", "__fx", "__fy").agg(F.count("name").alias("__n")))
    cells = spot_sites.groupBy("__fx", "__fy").agg(F.sum("__n").alias("__n"))

    spots = spots.withColumn("__fx", grid.cell("x", F.col("__lon"))).withColumn("__fy", grid.cell("y", F.col("__lat")))
    spots = cut_lineage(spots)
    tiles = cut_lineage(disc_tiles(spots, cells, grid, method, radius_km, leaf=8))
    tile, asker = ["__l", "__tx", "__ty"], ["__l", "__gx", "__gy"]
    used = levels_in(tiles) or [0]
    spot = ["__lat", "__lon", "amenity"]
    asked = at_levels(spots, used).withColumnsRenamed({"__tx": "__gx", "__ty": "__gy"}).select(*asker, "__lat", "__lon")
    # whole tiles add up per asking tile, before its places take the sum
    whole = tiles.where("__whole").join(exchanged(counted(spot_sites, used, ["amenity"])), tile).groupBy(*asker, "amenity").agg(F.sum("__n").alias("__n"))
    whole = asked.join(exchanged(whole), asker).select(*spot, "__n")
    gap = metric(method, F.col("__lat"), F.col("__lon"), F.col("__slat"), F.col("__slon"))
    rim = tiles.where("NOT __whole").join(exchanged(at_levels(spot_sites, used)), tile).select(*asker, "amenity", "__slat", "__slon", "__n")
    rim = asked.join(exchanged(rim), asker).where(gap <= radius_km).select(*spot, "__n")
    counts = whole.unionByName(rim).groupBy(*spot).agg(F.sum("__n").alias("n"))

    asks = spots.select(F.struct("__lat", "__lon").alias("spot"), F.col("__lat").alias("lat"), F.col("__lon").alias("lon"))
    asks = asks.withColumn("amenity", F.explode(F.array(*[F.lit(a) for a in amenities])))
    places = spot_sites.select("amenity", F.col("__slat").alias("lat"), F.col("__slon").alias("lon"), F.struct("__slat", "__slon").alias("site"))
    near = nearest(asks.withColumn("ask", F.struct("spot", "amenity")), places, 1, "ask", "site", by=["amenity"], within=radius_km, method=method)
    near = near.select(F.col("ask.spot.__lat").alias("__lat"), F.col("ask.spot.__lon").alias("__lon"), F.col("ask.amenity").alias("amenity"), (F.col("distance") * 1000).alias("d"))
    both = counts.join(exchanged(near), spot, "left")
    aggs = []
    for a in amenities:
        hit = F.col("amenity") == a
        aggs += [F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias(f"count_{a}"), F.min(F.when(hit, F.col("d"))).alias(f"min_dist_{a}")]
    per_spot = both.groupBy(F.struct("__lat", "__lon").alias("__spot")).agg(*aggs)
    keyed = listings.select(key, F.struct(F.col("lat").alias("__lat"), F.col("lon").alias("__lon")).alias("__spot"))
    return keyed.join(exchanged(per_spot), "__spot", "left").drop("__spot")


# --- polygons ----------------------------------------------------------------------


def as_shape(df: DataFrame, column: str) -> Column:
    """A column of one ring, of the rings of one polygon, or of parts of rings, as parts of rings."""
    kind, depth = df.schema[column].dataType, 0
    while isinstance(kind, ArrayType):
        kind, depth = kind.elementType, depth + 1
    shape = F.col(column)
    for _ in range(3 - depth):
        shape = F.when(shape.isNotNull(), F.array(shape))
    return shape


#: Levels below the one at which a polygon's box spans at most 3x3 tiles: fewer points are measured against edges.
_FINER = 2


def points_in_polygons(
    polygons: DataFrame,
    points: DataFrame,
    ring: str = "ring",
    lat: str = "lat",
    lon: str = "lon",
    edges_per_strip: int = 8,
    most_strips: int = 256,
) -> DataFrame:
    """Inner join polygons x points where the polygon covers the point (boundaries count).

    ``ring`` is a ring, the rings of a polygon (holes after the outline), or
    parts of rings; it is left out of the result. Each polygon takes the level
    at which its box spans at most 9x9 tiles, each point is offered once per
    level in use. Tiles outside the polygon are left out, tiles without an edge
    take all of their points, the others carry the edges that their points'
    rays can meet, in horizontal strips; the parity of crossed edges answers for
    parts and holes alike. Pairs are made in the tile join and not exchanged.
    """
    named = [c for c in polygons.columns if c != ring]
    spread = int(polygons.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shaped = polygons.withColumn("__shape", as_shape(polygons, ring)).where(F.col(ring).isNotNull()).repartition(spread)

    def sound(r: Column) -> Column:
        first, last = F.get(r, F.lit(0)), F.get(r, F.size(r) - 1)
        return (first.x == last.x) & (first.y == last.y) & F.forall(r, lambda p: p.x.isNotNull() & p.y.isNotNull())

    closed = F.coalesce(F.forall(F.flatten("__shape"), sound), F.lit(False))
    frozen = cut_lineage(shaped.select(*named, shape_edges(F.col("__shape")).alias("__e"), closed.alias("__closed")))
    ends = lambda a: F.transform("__e", lambda e: e[a])  # noqa: E731 (rings are closed, so first ends are all corners)
    boxed = frozen.withColumns({"__x0": F.array_min(ends("ax")), "__x1": F.array_max(ends("ax")), "__y0": F.array_min(ends("ay")), "__y1": F.array_max(ends("ay"))})

    points = points.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    grid = tiling([(points, lat, lon)], "planar")
    span = F.greatest(F.col("__x1") - F.col("__x0"), F.col("__y1") - F.col("__y0"), F.lit(grid.side / 2**DEEPEST))
    level = F.least(F.greatest(F.floor(F.log2(F.lit(grid.side) / span)) + 1 + _FINER, F.lit(0)), F.lit(DEEPEST)).cast("int")
    boxes = boxed.withColumn("__l", level)
    levels = levels_in(boxes.where(F.col("__l").isNotNull())) or [0]
    last = 2**DEEPEST - 1  # boxes larger than the extent are cut to it

    def span_of(axis: str, a: str, b: str) -> Column:
        lo, hi = (up(F.greatest(F.least(grid.cell(axis, F.col(c)), F.lit(last)), F.lit(0)), F.col("__l")) for c in (a, b))
        return F.sequence(lo, hi)

    # Tiles are taken a little wider than they are: rounding keeps no edge from a point.
    wider = grid.side * 1e-9 + max(abs(grid.x0), abs(grid.y0)) * 1e-12
    covered = boxes.withColumn("__tx", F.explode(span_of("x", "__x0", "__x1"))).withColumn("__ty", F.explode(span_of("y", "__y0", "__y1")))
    tile = F.lit(grid.side) / F.pow(F.lit(2.0), F.col("__l"))
    west, south = F.lit(grid.x0) + F.col("__tx") * tile, F.lit(grid.y0) + F.col("__ty") * tile
    covered = covered.withColumns({"__w": west - wider, "__o": west + tile + wider, "__s": south - wider, "__n": south + tile + wider})
    low, high = lambda e: F.least(e.ay, e.by), lambda e: F.greatest(e.ay, e.by)
    meets = lambda e: (high(e) >= F.col("__s")) & (low(e) <= F.col("__n")) & (F.greatest(e.ax, e.bx) >= F.col("__w"))
    covered = covered.withColumn("__e", F.filter("__e", meets)).where(F.size("__e") > 0)
    rim = F.coalesce(F.exists("__e", lambda e: F.least(e.ax, e.bx) <= F.col("__o")), F.lit(True))
    covered = covered.withColumn("__whole", F.col("__closed") & ~rim)
    middle = (F.col("__s") + F.col("__n")) / 2
    inside = F.size(F.filter("__e", lambda e: (e.ay > middle) != (e.by > middle))) % 2 == 1
    covered = covered.where(~F.col("__whole") | inside)
    strips = F.least(F.ceil(F.size("__e") / edges_per_strip), F.lit(most_strips)).cast("int")
    covered = covered.withColumn("__strips", strips).withColumn("__h", (F.col("__n") - F.col("__s")) / F.col("__strips"))

    def strip(y: Column) -> Column:
        at = F.floor((F.greatest(F.least(y, F.col("__n")), F.col("__s")) - F.col("__s")) / F.col("__h"))
        return F.least(at.cast("int"), F.col("__strips") - 1)

    crossing = F.transform(F.sequence(F.lit(0), F.col("__strips") - 1), lambda k: F.filter("__e", lambda e: (strip(low(e)) <= k) & (strip(high(e)) >= k)))
    covered = covered.withColumn("__edges", F.when(~F.col("__whole"), crossing)).drop("__e", "__closed", "__w", "__o")
    placed = points.withColumn("__fx", grid.cell("x", F.col(lon))).withColumn("__fy", grid.cell("y", F.col(lat)))
    offered = at_levels(placed, levels).drop("__fx", "__fy")
    x, y = F.col(lon), F.col(lat)
    in_box = x.between(F.col("__x0"), F.col("__x1")) & y.between(F.col("__y0"), F.col("__y1"))
    key = ["__l", "__tx", "__ty"]
    # few bytes make many pairs, so the tasks are not put together by bytes
    covered, offered = (side.repartition(spread, *key) for side in (covered, offered))
    met = covered.join(exchanged(offered), key)
    found = met.where(F.col("__whole") | (in_box & edges_cover(F.get("__edges", strip(y)), x, y)))
    return found.select(*named, *points.columns)


def best_schools(
    isochrones: DataFrame,
    schools: DataFrame,
    key: str = "property_id",
    band: str = "band",
    method: str = "geodesic",
) -> DataFrame:
    """Per (key, band): best school by decayed goodness, and the number of schools covered.

    ``isochrones``: key, band, ring (a ring or a whole shape), year, listing_lat, listing_lon.
    ``schools``: school_name, school_goodness, establishment_year, lat, lon.
    Schools founded after the listing year do not count. Bands with a polygon
    but no school come back with NULLs.
    """
    def scored(bands: DataFrame) -> DataFrame:
        found = points_in_polygons(bands, schools).where(
            F.col("establishment_year").isNull() | (F.col("establishment_year") <= F.col("year"))
        )
        km = distance_km(F.col("listing_lat"), F.col("listing_lon"), F.col("lat"), F.col("lon"), method)
        return found.withColumn("__km", km).withColumn("__score", distance_decay(F.col("school_goodness"), F.col("__km")))

    # Numbers add up in place as the pairs are made. Names do not: with them the pairs would be sorted first,
    # so only the pairs at the best score are looked up, in a second pass.
    top = cut_lineage(scored(isochrones).groupBy(key, band).agg(F.max("__score").alias("__top"), F.count("school_name").alias("n_schools")))
    score, most = F.col("__score"), F.col("__top")
    led = isochrones.join(exchanged(top.where(most.isNotNull()).drop("n_schools")), [key, band])
    best = scored(led).where((score == most) | (score >= most - F.abs(most) * 1e-9))
    item = F.struct(
        F.col("school_name").alias("name"), F.struct("lat", "lon").alias("coord"), F.col("__score").alias("score"), F.col("__km").alias("km")
    )
    rank = F.when(F.col("__score").isNotNull(), F.struct(F.col("__score").alias("s"), F.col("school_name").alias("t")))
    best = best.groupBy(key, band).agg(F.max_by(item, rank).alias("__b"))
    shown = top.join(exchanged(best), [key, band], "left").select(
        key,
        band,
        F.col("__b.name").alias("best_school_name"),
        F.col("__b.coord").alias("best_school_coord"),
        F.col("__b.score").alias("best_score"),
        F.col("__b.km").alias("best_dist_km"),
        "n_schools",
    )
    have = isochrones.where(F.col("ring").isNotNull()).select(key, band).distinct()
    return have.join(exchanged(shown), [key, band], "left")


# --- imputation from neighbours -----------------------------------------------------


def nearest_gifts(
    df: DataFrame, columns: Sequence[str], key: str, group: str = "suburb", lat: str = "lat", lon: str = "lon"
) -> DataFrame:
    """(key, __g_<column>...): what each row with a NULL among ``columns`` receives.

    The narrow input is frozen first, because donors, receivers and their
    groups are all read from it.
    """
    columns = list(columns)
    df = cut_lineage(df.select(*dict.fromkeys([key, group, lat, lon, *columns])))
    null_any = F.lit(False)
    for c in columns:
        null_any = null_any | F.col(c).isNull()
    needy = df.where(null_any).select(key, group, lat, lon)
    donors = df.where(~null_any).withColumnRenamed(key, "__donor")
    kw = {"k": 1, "point_id": key, "site_id": "__donor", "method": "planar", "lat": lat, "lon": lon}
    served = donors.where(F.col(group).isNotNull()).select(group).distinct()
    local = nearest(needy.join(served, group, "left_semi"), donors, by=[group], **kw)
    far = nearest(needy.join(served, group, "left_anti"), donors, **kw)
    gifts = donors.select("__donor", *[F.col(c).alias(f"__g_{c}") for c in columns])
    return local.unionByName(far).select(key, "__donor").join(exchanged(gifts), "__donor").drop("__donor")


def impute_nearest(
    df: DataFrame,
    columns: Sequence[str],
    key: str,
    group: str = "suburb",
    lat: str = "lat",
    lon: str = "lon",
    suffix: str = "",
) -> DataFrame:
    """Fill NULLs from the nearest row (planar degrees) of the same group whose listed
    columns are all non-null; groups without such a row use the nearest row anywhere.

    Donors are always original rows, so the result does not depend on row order.
    """
    given = nearest_gifts(df, columns, key, group, lat, lon)
    out = df.join(exchanged(given), key, "left").withColumns(
        {c + suffix: F.coalesce(F.col(c), F.col(f"__g_{c}")) for c in columns}
    )
    return out.drop(*[f"__g_{c}" for c in columns])


# --- weights -------------------------------------------------------------------------


def neighbour_weights(
    places: DataFrame,
    name: str = "locality",
    k: int = 15,
    strength: float = 1.0,
    eps: float = 1e-4,
    method: str = "haversine",
    lat: str = "lat",
    lon: str = "lon",
) -> DataFrame:
    """Symmetric edges (src, dst, w): w = strength / (km + eps) to the k nearest others."""
    near = nearest(places, places, k, name, name, method=method, lat=lat, lon=lon, exclude_self=True)
    w = F.lit(strength) / (F.col("distance") + F.lit(eps))
    one = near.where(F.col("distance") > 0).select(
        F.col(name).alias("src"), F.col("neighbour").alias("dst"), w.alias("w")
    )
    both = one.unionByName(one.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w"))
    return both.groupBy("src", "dst").agg(F.max("w").alias("w"))


def combo_weights(edges: DataFrame, places: DataFrame, units: DataFrame, place: str = "locality", unit: str = "suburb", drop_self: bool = False) -> DataFrame:
    """Sum of base weights over parts(i) x parts(j) for panel units.

    A unit found among the places stands for itself, any other is split on '-';
    units with a missing part get no edges.
    """
    known = places.select(F.col(place).alias("__p")).distinct()
    names = units.select(F.col(unit).alias("unit")).distinct()
    single = names.join(known, names["unit"] == known["__p"], "left_semi").select("unit", F.col("unit").alias("part"))
    split = names.join(known, names["unit"] == known["__p"], "left_anti").select(
        "unit", F.explode(F.split("unit", "-")).alias("part")
    )
    missing = split.join(known, split["part"] == known["__p"], "left_anti").select("unit").distinct()
    parts = single.unionByName(split.join(missing, "unit", "left_anti"))
    out = (
        edges.join(parts.select(F.col("part").alias("src"), F.col("unit").alias("__i")), "src")
        .join(parts.select(F.col("part").alias("dst"), F.col("unit").alias("__j")), "dst")
        .groupBy(F.col("__i").alias("src"), F.col("__j").alias("dst"))
        .agg(F.sum("w").alias("w"))
    )
    return out.where(F.col("src") != F.col("dst")) if drop_self else out


def row_stochastic(edges: DataFrame) -> DataFrame:
    """Weights divided by their row total (aggregate and join; rows of zeros stay absent)."""
    totals = edges.groupBy("src").agg(F.sum("w").alias("__t")).where(F.col("__t") != 0)
    return edges.join(totals, "src").select("src", "dst", (F.col("w") / F.col("__t")).alias("w"))


def sparsity(edges: DataFrame, units: DataFrame, unit: str) -> DataFrame:
    n = units.agg(F.count_distinct(unit)).scalar()
    nonzero = F.count_if(F.col("w") != 0)
    return edges.agg(nonzero.alias("nonzero"), F.max(n).alias("n")).select(
        "nonzero", "n", (1 - F.col("nonzero") / (F.col("n") * F.col("n"))).alias("sparsity")
    )


def first_geometry(df: DataFrame, keys: Sequence[str], geometry: Sequence[str], tie: str, name: str = "num_stops") -> DataFrame:
    """Count per group and the first geometry by ``tie``."""
    pick = F.min_by(F.struct(*geometry), tie)
    out = df.groupBy(*keys).agg(F.count("*").alias(name), pick.alias("__g"))
    return out.select(*keys, name, *[F.col("__g")[c].alias(c) for c in geometry])
