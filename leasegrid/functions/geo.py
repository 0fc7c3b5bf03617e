"""Geometry as column expressions over named lat/lon doubles and WKT text."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from leasegrid import constants as C

_NUMBER = r"[-+]?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?"


def clean_token(c: Column) -> Column:
    """'', 'nan', 'none' (any case) and blanks become NULL."""
    text = F.trim(c)
    return F.when(~F.lower(text).isin("", "nan", "none"), text)


def wkt_point(c: Column, order: str = "auto") -> Column:
    """Struct(lat, lon) of a WKT point. ``order``: 'latlon', 'lonlat' or 'auto'.

    'auto' reads the axis whose magnitude exceeds 90 as longitude; when neither
    does, the first number is the longitude (the WKT convention).
    """
    pattern = rf"(?i)^\s*POINT\s*\(\s*({_NUMBER})\s+({_NUMBER})\s*\)\s*$"
    a = F.nullif(F.regexp_extract(c, pattern, 1), F.lit("")).try_cast("double")
    b = F.nullif(F.regexp_extract(c, pattern, 2), F.lit("")).try_cast("double")
    if order == "latlon":
        lat, lon = a, b
    elif order == "lonlat":
        lat, lon = b, a
    else:
        swapped = (F.abs(b) > 90) & (F.abs(a) <= 90)
        lat, lon = F.when(swapped, a).otherwise(b), F.when(swapped, b).otherwise(a)
    return F.when(a.isNotNull() & b.isNotNull(), F.struct(lat.alias("lat"), lon.alias("lon")))


def swap_point_text(c: Column) -> Column:
    """'POINT (a b)' -> 'POINT (b a)'; other text unchanged."""
    return F.regexp_replace(c, r"POINT \(\s*(\S+)\s+(\S+?)\s*\)", "POINT ($2 $1)")


def point_text(x: Column, y: Column) -> Column:
    return F.concat(
        F.lit("POINT ("), x.cast("string"), F.lit(" "), y.cast("string"), F.lit(")")
    )


def wkt_ring(c: Column) -> Column:
    """Outer ring of a WKT polygon as ARRAY<STRUCT<x,y>>; NULL for unusable text."""
    body = F.nullif(
        F.regexp_extract(clean_token(c), r"(?is)^POLYGON\s*Z?\s*\(\s*\(([^()]+)\)", 1), F.lit("")
    )
    ring = F.transform(
        F.split(F.trim(body), r"\s*,\s*"),
        lambda p: F.struct(
            F.get(F.split(F.trim(p), r"\s+"), F.lit(0)).try_cast("double").alias("x"),
            F.get(F.split(F.trim(p), r"\s+"), F.lit(1)).try_cast("double").alias("y"),
        ),
    )
    usable = (F.size(ring) >= 4) & F.forall(ring, lambda p: p.x.isNotNull() & p.y.isNotNull())
    return F.when(usable, ring)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def wkt_shape(c: Column) -> Column:
    """POLYGON or MULTIPOLYGON text as parts of rings: ARRAY<ARRAY<ARRAY<STRUCT<x,y>>>>.

    The first ring of a part is its outline, the others are holes; further
    ordinates (Z, M) are dropped. NULL for unusable text: another geometry, an
    empty one, unbalanced brackets, a coordinate that is no number, or a ring
    that is shorter than four points or not closed.
    """
    kind = r"(?is)^\s*(MULTI)?POLYGON\s*(?:ZM|Z|M)?\s*(\(.*\))\s*$"

    def point(words: Column) -> Column:
        return F.struct(*[F.get(words, F.lit(i)).try_cast("double").alias(axis) for i, axis in enumerate("xy")])

    def parse(inner: Column) -> Column:
        return F.transform(
            F.split(inner, r"\)\),\(\("),
            lambda part: F.transform(
                F.split(part, r"\),\("), lambda ring: F.transform(F.transform(F.split(ring, ","), lambda p: F.split(F.trim(p), r"\s+")), point)
            ),
        )

    def sound(ring: Column) -> Column:
        numbers = F.forall(ring, lambda p: p.x.isNotNull() & p.y.isNotNull() & ~F.isnan(p.x) & ~F.isnan(p.y))
        closed = (F.element_at(ring, 1).x == F.element_at(ring, -1).x) & (F.element_at(ring, 1).y == F.element_at(ring, -1).y)
        return (F.size(ring) >= 4) & numbers & F.coalesce(closed, F.lit(False))

    def bracketed(text: Column) -> Column:
        body = F.regexp_replace(F.regexp_extract(text, kind, 2), r"\s*([(),])\s*", "$1")
        single = F.regexp_extract(text, kind, 1) == ""
        return F.concat(F.when(single, "(").otherwise(""), body, F.when(single, ")").otherwise(""))

    def inside(body: Column) -> Column:
        return F.when(body.rlike(r"^\(\(\([^()]") & body.rlike(r"[^()]\)\)\)$"), body.substr(F.lit(4), F.length(body) - 6))

    inner = _once(_once(_once(c, clean_token), bracketed), inside)
    return _once(_once(inner, parse), lambda shape: F.when(F.forall(F.flatten(shape), sound), shape))


def ring_text(points: Column) -> Column:
    """ARRAY<ARRAY<DOUBLE>> coordinates to WKT; '' for an empty ring."""
    pairs = F.transform(points, lambda p: F.concat_ws(" ", p[0].cast("string"), p[1].cast("string")))
    text = F.concat(F.lit("POLYGON (("), F.array_join(pairs, ", "), F.lit("))"))
    return F.when(F.coalesce(F.size(points), F.lit(0)) > 0, text).otherwise("")


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    s1 = F.sin(F.radians(lat2 - lat1) / 2)
    s2 = F.sin(F.radians(lon2 - lon1) / 2)
    a = s1 * s1 + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * s2 * s2
    return F.lit(2 * C.EARTH_RADIUS_KM) * F.asin(F.least(F.sqrt(a), F.lit(1.0)))


def planar_degrees(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dy, dx = lat2 - lat1, lon2 - lon1
    return F.sqrt(dy * dy + dx * dx)


def projected_km(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Distance in km between already projected metric x/y columns."""
    return F.sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) / 1000


@F.pandas_udf(DoubleType())
def geodesic_m(lat1: pd.Series, lon1: pd.Series, lat2: pd.Series, lon2: pd.Series) -> pd.Series:
    """WGS84 geodesic length in metres (Vincenty's inverse formula, vectorised)."""
    a, f = C.WGS84_A, C.WGS84_F
    b = a * (1 - f)
    p1, p2 = np.radians(lat1.to_numpy(float)), np.radians(lat2.to_numpy(float))
    dl = np.radians(lon2.to_numpy(float) - lon1.to_numpy(float))
    u1, u2 = np.arctan((1 - f) * np.tan(p1)), np.arctan((1 - f) * np.tan(p2))
    su1, cu1, su2, cu2 = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)
    lam = dl.copy()
    with np.errstate(divide="ignore", invalid="ignore"):
        for _ in range(30):
            sl, cl = np.sin(lam), np.cos(lam)
            sin_s = np.hypot(cu2 * sl, cu1 * su2 - su1 * cu2 * cl)
            cos_s = su1 * su2 + cu1 * cu2 * cl
            sigma = np.arctan2(sin_s, cos_s)
            sin_a = np.where(sin_s == 0, 0.0, cu1 * cu2 * sl / sin_s)
            cos2_a = 1 - sin_a**2
            cos_2m = np.where(cos2_a == 0, 0.0, cos_s - 2 * su1 * su2 / cos2_a)
            c = f / 16 * cos2_a * (4 + f * (4 - 3 * cos2_a))
            inner = sigma + c * sin_s * (cos_2m + c * cos_s * (2 * cos_2m**2 - 1))
            lam = dl + (1 - c) * f * sin_a * inner
        k = cos2_a * (a * a - b * b) / (b * b)
        big_a = 1 + k / 16384 * (4096 + k * (-768 + k * (320 - 175 * k)))
        big_b = k / 1024 * (256 + k * (-128 + k * (74 - 47 * k)))
        step = cos_s * (2 * cos_2m**2 - 1) - big_b / 6 * cos_2m * (4 * sin_s**2 - 3) * (
            4 * cos_2m**2 - 3
        )
        d_sigma = big_b * sin_s * (cos_2m + big_b / 4 * step)
    return pd.Series(b * big_a * (sigma - d_sigma))


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column, method: str = "haversine") -> Column:
    """One switch over the three distance models in use ('planar' is in degrees)."""
    if method == "haversine":
        return haversine_km(lat1, lon1, lat2, lon2)
    if method == "planar":
        return planar_degrees(lat1, lon1, lat2, lon2)
    if method == "geodesic":
        return geodesic_m(lat1, lon1, lat2, lon2) / 1000
    raise ValueError(f"unknown distance method {method!r}")


def ring_edges(ring: Column) -> Column:
    """ARRAY<STRUCT<ax, ay, bx, by>> of a ring's edges."""
    return F.zip_with(
        F.slice(ring, F.lit(1), F.size(ring) - 1),
        F.slice(ring, F.lit(2), F.size(ring) - 1),
        lambda a, b: F.struct(a.x.alias("ax"), a.y.alias("ay"), b.x.alias("bx"), b.y.alias("by")),
    )


def shape_edges(shape: Column) -> Column:
    """Edges of all rings of all parts. Counted crossings are even inside a hole, odd inside a part."""
    return F.flatten(F.transform(F.flatten(shape), ring_edges))


def edges_cover(edges: Column, x: Column, y: Column) -> Column:
    """True when the point is inside the ring of these edges or on its boundary."""

    def on_edge(e: Column) -> Column:
        cross = (e.bx - e.ax) * (y - e.ay) - (e.by - e.ay) * (x - e.ax)
        within_x = x.between(F.least(e.ax, e.bx), F.greatest(e.ax, e.bx))
        return (cross == 0) & within_x & y.between(F.least(e.ay, e.by), F.greatest(e.ay, e.by))

    def crosses(e: Column) -> Column:
        at_x = (e.bx - e.ax) * (y - e.ay) / F.nullif(e.by - e.ay, F.lit(0.0)) + e.ax
        return ((e.ay > y) != (e.by > y)) & (x < at_x)

    return (F.size(F.filter(edges, crosses)) % 2 == 1) | F.exists(edges, on_edge)


def ring_covers(ring: Column, x: Column, y: Column) -> Column:
    return edges_cover(ring_edges(ring), x, y)
