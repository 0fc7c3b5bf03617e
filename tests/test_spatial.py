"""Pyramid searches and polygons against brute force."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from leasegrid.functions import geo
from leasegrid.operators import pyramid, spatial

PLACE = "id int, lat double, lon double"


def _km(a, b, c, d):
    a, b, c, d = map(np.radians, (a, b, c, d))
    h = np.sin((c - a) / 2) ** 2 + np.cos(a) * np.cos(c) * np.sin((d - b) / 2) ** 2
    return 2 * 6371.0088 * np.arcsin(np.sqrt(np.minimum(h, 1)))


def _brute_nearest(points, sites, k):
    s = np.array([x[1:3] for x in sites])
    out = {}
    for pid, lat, lon in points:
        d = _km(lat, lon, s[:, 0], s[:, 1])
        out[pid] = sorted(zip(d.round(6).tolist(), [x[0] for x in sites]))[:k]
    return out


def _nearest(spark, points, sites, k, **kw):
    got = {}
    p, s = spark.createDataFrame(points, PLACE), spark.createDataFrame(sites, PLACE).withColumnRenamed("id", "sid")
    for r in spatial.nearest(p, s, k, "id", "sid", **kw).collect():
        got.setdefault(r.id, []).append((round(r.distance, 6), r.sid))
    return {k: sorted(v) for k, v in got.items()}


@pytest.mark.parametrize("k", [1, 5])
def test_far_points_and_dense_clusters(spark, k):
    """Every site in two tight clusters, points anywhere: coarse blocks hold thousands of sites and must descend."""
    rng = random.Random(1)
    sites = [(i, -37.8 + rng.gauss(0, 0.01), 144.9 + rng.gauss(0, 0.01)) for i in range(2000)]
    sites += [(5000 + i, -36.7 + rng.gauss(0, 1e-4), 144.3 + rng.gauss(0, 1e-4)) for i in range(1500)]
    points = [(i, rng.uniform(-39, -34), rng.uniform(141, 149)) for i in range(60)] + [(100 + i, *s[1:]) for i, s in enumerate(sites[::200])]
    assert _nearest(spark, points, sites, k) == _brute_nearest(points, sites, k)


def test_around_the_world(spark):
    """Sparse sites over all longitudes and up to the poles; no block bound holds there, only the balls do."""
    rng = random.Random(2)
    sites = [(i, rng.uniform(-89, 89), rng.uniform(-180, 180)) for i in range(900)]
    points = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(40)]
    p, s = spark.createDataFrame(points, PLACE), spark.createDataFrame(sites, PLACE)
    grid = pyramid.tiling([(p, "lat", "lon"), (s, "lat", "lon")], "haversine")
    cells = s.select(grid.cell("x", F.col("lon")).alias("__fx"), grid.cell("y", F.col("lat")).alias("__fy"), F.lit(1).alias("__n"))
    asked = p.select(grid.cell("x", F.col("lon")).alias("__fx"), grid.cell("y", F.col("lat")).alias("__fy"))
    root = asked.select("*", F.lit(0).alias("__l"), F.lit(0).cast("long").alias("__tx"), F.lit(0).cast("long").alias("__ty"))
    tiles = pyramid.nearest_tiles(root, cells, grid, "haversine", 3, None, (), leaf=8)
    used = pyramid.levels_in(tiles)
    here = s.withColumns({"__fx": grid.cell("x", F.col("lon")), "__fy": grid.cell("y", F.col("lat"))}).withColumnRenamed("id", "sid")
    offered = pyramid.at_levels(here, used).select("__l", "__tx", "__ty", "sid")
    at = p.withColumns({"__fx": grid.cell("x", F.col("lon")), "__fy": grid.cell("y", F.col("lat"))}).select("id", "__fx", "__fy")
    met = {}
    for r in at.join(tiles, ["__fx", "__fy"]).join(offered, ["__l", "__tx", "__ty"]).select("id", "sid").collect():
        met.setdefault(r.id, set()).add(r.sid)
    for pid, near in _brute_nearest(points, sites, 3).items():
        assert {sid for _, sid in near} <= met[pid]
    assert sum(map(len, met.values())) < 40 * 60


def test_many_far_points_meet_few_candidates(spark):
    """20,000 points far from 20,000 sites."""
    sites = spark.range(20_000).select(F.col("id").alias("sid"), (F.rand(1) * 0.2 - 38).alias("lat"), (F.rand(2) * 0.2 + 145).alias("lon"))
    points = spark.range(20_000).select("id", (F.rand(3) * 0.5 - 30).alias("lat"), (F.rand(4) * 0.5 + 130).alias("lon"))
    start = time.time()
    got = spatial.nearest(points, sites, 3, "id", "sid").agg(F.count("*"), F.max("rank")).first()
    assert tuple(got) == (60_000, 3)
    assert time.time() - start < 120


def test_geodesic_nearest(spark):
    rng = random.Random(3)
    sites = [(i, rng.uniform(-38, -37), rng.uniform(144, 146)) for i in range(300)]
    points = [(i, rng.uniform(-38, -37), rng.uniform(144, 146)) for i in range(20)]
    p, s = spark.createDataFrame(points, PLACE), spark.createDataFrame(sites, PLACE)
    all_pairs = p.crossJoin(s.select(F.col("id").alias("sid"), F.col("lat").alias("a"), F.col("lon").alias("b")))
    far = {}
    for r in all_pairs.withColumn("d", geo.geodesic_m(F.col("lat"), F.col("lon"), F.col("a"), F.col("b"))).collect():
        far.setdefault(r.id, []).append((r.d, r.sid))
    want = {k: {s for _, s in sorted(v)[:4]} for k, v in far.items()}
    got = {k: {s for _, s in v} for k, v in _nearest(spark, points, sites, 4, method="geodesic").items()}
    assert got == want


@pytest.mark.parametrize("method", ["haversine", "geodesic"])
def test_amenities_equal_the_pairs(spark, method):
    rng = random.Random(5)
    kinds = ["cafe", "bank", "prison", "tree"]
    pois = [(f"n{i}" if i % 7 else None, kinds[i % 4], -37.8 + rng.gauss(0, 0.01), 144.9 + rng.gauss(0, 0.012)) for i in range(1500)]
    pois += [("copy", "cafe", -37.8, 144.9)] * 50 + [("x", "bank", None, 144.9)]
    homes = [(i, -37.8 + rng.gauss(0, 0.02), 144.9 + rng.gauss(0, 0.02)) for i in range(40)] + [(90, -30.0, 140.0), (91, None, 144.0), (92, -37.8, 144.9), (93, -37.8, 144.9)]
    h, p = spark.createDataFrame(homes, PLACE), spark.createDataFrame(pois, "name string, amenity string, lat double, lon double")
    pairs = spatial.within_radius(h, p.where(F.col("amenity").rlike("cafe|bank|prison")), 1.5, method)
    want = {r.id: tuple(r)[1:] for r in spatial.amenity_summary(pairs, "id", "amenity", ["cafe", "bank"]).collect()}
    got = {r.id: tuple(r)[1:] for r in spatial.amenities_near(h, p, "id", "cafe|bank|prison", ["cafe", "bank"], 1.5, method).collect()}
    assert set(got) == {r[0] for r in homes} and len(want) > 20
    for k, row in got.items():
        if k not in want:
            assert row == (None,) * 4
            continue
        assert row[0::2] == want[k][0::2]
        known = lambda d: [-1.0 if v is None else v for v in d[1::2]]
        assert known(row) == pytest.approx(known(want[k]), rel=1e-9)


def test_dense_disc_lists_no_pairs(spark):
    """5,000 homes and 20,000 places in one two-kilometre tile: 10^8 pairs if listed."""
    homes = spark.range(5_000).select("id", (F.rand(1) * 0.018 - 37.8).alias("lat"), (F.rand(2) * 0.022 + 144.9).alias("lon"))
    pois = spark.range(20_000).select(F.lit("n").alias("name"), F.when(F.col("id") % 2 == 0, "cafe").otherwise("bank").alias("amenity"), (F.rand(3) * 0.018 - 37.8).alias("lat"), (F.rand(4) * 0.022 + 144.9).alias("lon"))
    out = spatial.amenities_near(homes, pois, "id", "cafe|bank", ["cafe", "bank"], 2.0, "haversine")
    assert out.where("count_cafe > 3000 AND min_dist_bank < 200").count() > 4_000


SHAPES = {
    "square with hole": "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0), (3 3, 6 3, 6 6, 3 6, 3 3))",
    "two parts": "MULTIPOLYGON (((20 0, 25 0, 25 5, 20 0)), ((30 30, 40 30, 40 40, 30 40, 30 30), (32 32, 38 32, 38 38, 32 38, 32 32)))",
    "island in hole": "MULTIPOLYGON(((50 50,60 50,60 60,50 60,50 50),(52 52,58 52,58 58,52 58,52 52)),((54 54,56 54,56 56,54 56,54 54)))",
    "z": "polygon z ((70 0 1, 75 0 1, 75 5 1, 70 0 1))",
}
BAD = ["", "nan", None, "POINT (1 2)", "POLYGON EMPTY", "MULTIPOLYGON EMPTY", "POLYGON ((0 0, 1 1, 0 0))", "POLYGON ((0 0, 1 1, 2 0, 3 3))",
       "POLYGON ((0 0, 1 x, 2 0, 0 0))", "POLYGON ((0 0, 1 1, 2 0, 0 0)", "MULTIPOLYGON (((0 0, 1 1, 2 0, 0 0))", "POLYGON ((0 0, 1 1, 2 0, 0 0), ())"]
#: (x, y): shapes that cover it
SPOTS = {
    (1.0, 1.0): {"square with hole"}, (4.0, 4.0): set(), (3.0, 4.0): {"square with hole"}, (10.0, 10.0): {"square with hole"}, (11.0, 5.0): set(),
    (24.0, 1.0): {"two parts"}, (21.0, 4.0): set(), (31.0, 31.0): {"two parts"}, (35.0, 35.0): set(), (32.0, 35.0): {"two parts"},
    (51.0, 55.0): {"island in hole"}, (53.0, 55.0): set(), (55.0, 55.0): {"island in hole"}, (74.0, 1.0): {"z"},
}


def test_shapes_with_holes_and_parts(spark):
    rows = [(n, w) for n, w in SHAPES.items()] + [(f"bad {i}", w) for i, w in enumerate(BAD)]
    shapes = spark.createDataFrame(rows, "name string, wkt string").withColumn("ring", geo.wkt_shape(F.col("wkt")))
    assert {r.name for r in shapes.where("ring IS NULL").collect()} == {f"bad {i}" for i in range(len(BAD))}
    points = spark.createDataFrame([(i, y, x) for i, (x, y) in enumerate(SPOTS)], PLACE)
    got = {i: set() for i in range(len(SPOTS))}
    for r in spatial.points_in_polygons(shapes, points).collect():
        got[r.id].add(r.name)
    assert list(got.values()) == list(SPOTS.values())


@pytest.mark.parametrize("strips", [1, 256])
def test_many_edges_in_strips(spark, strips):
    """A star with 600 corners and a hole; parity over strips equals a plain ray cast."""
    rng = random.Random(8)
    corner = lambda i, n, lo, hi: (np.cos(2 * np.pi * i / n) * rng.uniform(lo, hi), np.sin(2 * np.pi * i / n) * rng.uniform(lo, hi))
    outer, hole = [corner(i, 600, 0.6, 1.0) for i in range(600)], [corner(i, 60, 0.2, 0.3) for i in range(60)]
    ring = lambda r: [{"x": float(x), "y": float(y)} for x, y in [*r, r[0]]]
    shapes = spark.createDataFrame([(1, [ring(outer), ring(hole)])], "s int, ring array<array<struct<x:double,y:double>>>")
    points = [(i, rng.uniform(-1.1, 1.1), rng.uniform(-1.1, 1.1)) for i in range(800)]

    def inside(x, y):
        odd = False
        for r in (outer, hole):
            for (ax, ay), (bx, by) in zip(r, [*r[1:], r[0]]):
                if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                    odd = not odd
        return odd

    got = spatial.points_in_polygons(shapes, spark.createDataFrame(points, PLACE), most_strips=strips)
    assert {r.id for r in got.collect()} == {i for i, y, x in points if inside(x, y)}


def _sent_whole(monkeypatch, modules, result):
    """Plans (of what is frozen on the way, and of the result) that send a table whole through the driver."""
    plans = []

    def recorded(df, cut):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df)

    for m in modules:
        monkeypatch.setattr(m, "cut_lineage", lambda df, cut=m.cut_lineage: recorded(df, cut))
    plans.append(result()._jdf.queryExecution().executedPlan().toString())
    return [p for p in plans if "BroadcastHashJoin" in p]


def test_donor_search_sends_no_table_through_the_driver(spark, monkeypatch, tmp_path):
    rows = [(i, i % 3, i * 0.01, i * 0.02, None if i % 2 else float(i)) for i in range(40)]
    spark.createDataFrame(rows, "id int, suburb int, lat double, lon double, a double").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    near = lambda: spatial.nearest(df.where("a IS NULL"), df.where("a IS NOT NULL").withColumnRenamed("id", "sid"), 1, "id", "sid", by=["suburb"], method="planar")
    assert not _sent_whole(monkeypatch, [spatial, pyramid], near)
    assert spatial.impute_nearest(df, ["a"], "id").where("a IS NULL").count() == 0


@pytest.mark.parametrize("radius, method", [(8.0, "haversine"), (400.0, "haversine"), (3000.0, "haversine"), (8.0, "geodesic"), (0.05, "planar")])
def test_radius_meets_few_pairs_outside_the_disc(spark, radius, method):
    rng = random.Random(3)
    rows = [(i, rng.uniform(-38.5, -37.5), rng.uniform(144.3, 145.7)) for i in range(400)]
    p, s = spark.createDataFrame(rows[:200], PLACE), spark.createDataFrame(rows[200:], PLACE).withColumnRenamed("id", "sid")
    got = {(r.id, r.sid) for r in spatial.within_radius(p, s, radius, method).collect()}
    gap = pyramid.metric(method, F.col("lat"), F.col("lon"), F.col("slat"), F.col("slon"))
    every = p.crossJoin(s.withColumnsRenamed({"lat": "slat", "lon": "slon"})).where(gap <= radius)
    assert got == {(r.id, r.sid) for r in every.collect()}
    if radius == 8.0:
        grid, span = pyramid.tiling([(p, "lat", "lon"), (s, "lat", "lon")], "haversine"), pyramid.reach(method, radius)
        level = grid.level_reaching(span / spatial._TILES_PER_RADIUS)
        tiles = len(grid.steps_reaching(span, level)) * (grid.side / 2**level) ** 2
        assert tiles < 6 * np.pi * span**2  # a 3x3 block of tiles as long as the radius: up to 12


def test_amenity_summary_sends_no_table_through_the_driver(spark, monkeypatch, tmp_path):
    rows = [(i, i * 0.01, i * 0.02, "cafe" if i % 2 else "bank") for i in range(40)]
    spark.createDataFrame(rows, "id int, lat double, lon double, amenity string").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    pois = df.select(F.col("id").cast("string").alias("name"), "amenity", "lat", "lon")
    found = lambda: spatial.amenities_near(df.select("id", "lat", "lon"), pois, "id", "cafe|bank", ["cafe", "bank"], 12.0, "haversine")
    assert not _sent_whole(monkeypatch, [spatial, pyramid], found)


def test_shapes_are_parsed_once_and_by_many_tasks(spark, tmp_path):
    from leasegrid.queries.spatial_and_models import wkt_rings

    plan = spark.createDataFrame([("",)], "wkt string").select(geo.wkt_shape(F.col("wkt")))._jdf.queryExecution().analyzed().toString()
    assert plan.splitlines()[0].count("wkt#") <= 2  # the trimmed text was named, and parsed, dozens of times
    rows = [(i, i % 25, i * 1.5) for i in range(100)]
    spark.createDataFrame(rows, "s_suppkey long, s_nationkey int, s_acctbal double").coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    out = wkt_rings(spark, str(tmp_path))
    assert out.rdd.getNumPartitions() >= 8 and out.count() == 100


def test_points_of_one_tile_search_together(spark, monkeypatch):
    kept = []
    for m in (spatial, pyramid):
        real = m.cut_lineage
        monkeypatch.setattr(m, "cut_lineage", lambda df, real=real: (out := real(df), kept.append(out.count()))[0])
    place = lambda n, seed: spark.range(n).select("id", (F.rand(seed) - 37).alias("lat"), (F.rand(seed + 1) + 145).alias("lon"))
    out = spatial.nearest(place(20_000, 1), place(400, 3).withColumnRenamed("id", "sid"), 5, "id", "sid")
    assert out.count() == 100_000
    assert max(kept) < 3 * 20_000  # a row per point and tile of its block: at least nine times the points


def test_amenities_of_one_tile_are_counted_together(spark, monkeypatch):
    kept = []
    for m in (spatial, pyramid):
        real = m.cut_lineage
        monkeypatch.setattr(m, "cut_lineage", lambda df, real=real: (out := real(df), kept.append(out.count()))[0])
    place = lambda n, seed: spark.range(n).select("id", (F.rand(seed) - 37).alias("lat"), (F.rand(seed + 1) + 145).alias("lon"))
    pois = place(400, 3).select(F.col("id").cast("string").alias("name"), F.when(F.col("id") % 2 == 0, "cafe").otherwise("bank").alias("amenity"), "lat", "lon")
    out = spatial.amenities_near(place(10_000, 1), pois, "id", "cafe|bank", ["cafe", "bank"], 12.0, "haversine")
    assert out.count() == 10_000
    assert max(kept) < 5 * 10_000  # a row per home and tile of its block: at least nine times the homes


def _covers(shape, x, y):
    edges = [(a, b) for part in shape for ring in part for a, b in zip(ring, ring[1:])]
    xs, ys = ([a[k] for a, _ in edges] for k in (0, 1))
    if not (min(xs) <= x <= max(xs) and min(ys) <= y <= max(ys)):
        return False
    odd = False
    for (ax, ay), (bx, by) in edges:
        if (bx - ax) * (y - ay) == (by - ay) * (x - ax) and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
            return True
        odd ^= (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax
    return odd


def _any_shapes(rng, n):
    """Parts and holes anywhere, rings that cross themselves, level edges, flat shapes, and rings left open."""
    shapes = []
    for i in range(n):
        r, cx, cy = rng.choice([2, 9, 30, 90]), rng.randint(-10, 110), rng.randint(-10, 110)
        ring = lambda: [(cx + rng.randint(-r, r), cy + rng.choice([-r, 0, r, rng.randint(-r, r)])) for _ in range(rng.choice([2, 3, 5, 20]))]  # noqa: B023, E731
        shape = [[r if i % 7 == 3 else [*r, r[0]] for r in (ring() for _ in range(rng.randint(1, 2)))] for _ in range(rng.randint(1, 2))]
        shapes.append(shape)
    return shapes


@pytest.mark.parametrize("strips", [1, 256])
def test_any_shape_equals_the_plain_test(spark, strips):
    rng = random.Random(12)
    shapes = _any_shapes(rng, 60)
    points = [(i, float(rng.randint(0, 100)), float(rng.randint(0, 100))) for i in range(500)]
    rows = [(i, [[[{"x": float(x), "y": float(y)} for x, y in r] for r in part] for part in s]) for i, s in enumerate(shapes)]
    rows += [(90, None), (91, [[[{"x": 1.0, "y": None}, {"x": 50.0, "y": 3.0}, {"x": 60.0, "y": 50.0}, {"x": 1.0, "y": None}]]])]
    df = spark.createDataFrame(rows, "s int, ring array<array<array<struct<x:double,y:double>>>>")
    got = [(r.s, r.id) for r in spatial.points_in_polygons(df, spark.createDataFrame(points, PLACE), edges_per_strip=2, most_strips=strips).collect()]
    want = {(i, k) for i, s in enumerate(shapes) for k, y, x in points if _covers(s, x, y)}
    assert {g for g in got if g[0] < 90} == want and len(got) == len(set(got)) and len(want) > 3_000


def test_pairs_of_points_and_polygons_are_not_exchanged(spark):
    shapes = spark.createDataFrame([(1, [{"x": float(x), "y": float(y)} for x, y in ((0, 0), (4, 0), (4, 4), (0, 0))])], "s int, ring array<struct<x:double,y:double>>")
    points = spark.createDataFrame([(i, i % 5 + 0.5, i % 7 + 0.5) for i in range(70)], PLACE)
    plan = spatial.points_in_polygons(shapes, points)._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "Exchange" not in plan[: plan.index("Join")]
    assert plan.count("Join") == 1


def test_best_schools_equal_the_pairs(spark, monkeypatch):
    """Ties, unknown and negative goodness, repeated bands and NULL keys; pairs are added up as they are made, not sorted with their names."""
    rng, frozen = random.Random(14), []

    def recorded(df, cut=spatial.cut_lineage):
        frozen.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df)

    monkeypatch.setattr(spatial, "cut_lineage", recorded)
    shapes = _any_shapes(rng, 24)
    bands = [(i % 20 if i else None, ["walk", "drive"][i % 2], [[[(float(x), float(y)) for x, y in r] for r in part] for part in s], 2000 + i % 4, 50.0, 50.0) for i, s in enumerate(shapes)]
    bands.append((70, "walk", [[[(900.0, 900.0), (901.0, 900.0), (901.0, 901.0), (900.0, 900.0)]]], 2000, 50.0, 50.0))
    schools = [(f"s{i % 190}" if i % 11 else None, rng.choice([None, -1.0, 0.0, 0.0, 5.0, 9.5]), rng.choice([None, 1999, 2001, 2003]), float(rng.randint(0, 100)), float(rng.randint(0, 100))) for i in range(200)]
    i = spark.createDataFrame(bands, "property_id int, band string, ring array<array<array<struct<x:double,y:double>>>>, year int, listing_lat double, listing_lon double")
    s = spark.createDataFrame(schools, "school_name string, school_goodness double, establishment_year int, lat double, lon double")
    got = {(r.property_id, r.band): r for r in spatial.best_schools(i, s, method="planar").collect()}
    met = {(k, b): [] for k, b, *_ in bands}
    for k, b, shape, year, y0, x0 in bands:
        for name, good, since, y, x in schools:
            if k is not None and _covers(shape, x, y) and (since is None or since <= year):
                d = np.sqrt((y - y0) ** 2 + (x - x0) ** 2)
                met[k, b].append((None if good is None else good / (1 + 0.2 * d), name, d))
    assert set(got) == set(met)
    for k, rows in met.items():
        r, known = got[k], [x for x in rows if x[0] is not None]
        assert (r.n_schools or 0) == sum(n is not None for _, n, _ in rows) and (r.n_schools is None) == (not rows)
        if not known:
            assert (r.best_school_name, r.best_score) == (None, None)
            continue
        top = max(x[0] for x in known)
        assert r.best_score == pytest.approx(top)
        names = [n for v, n, _ in known if v >= top - abs(top) * 1e-12 and n is not None]
        assert r.best_school_name in (names or [None])
        if top == 0:
            assert r.best_school_name == max(names, default=None)
    sums = [p for p in frozen if "partial_max(__score" in p]
    assert sums and not any("SortAggregate" in p for p in sums)
