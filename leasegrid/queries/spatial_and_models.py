"""Queries for spatial joins, matching, scores, models, forecasts and streaming."""

from __future__ import annotations

from datetime import date

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from leasegrid.functions.geo import wkt_shape
from leasegrid.operators import clean, forecast, joins, linear, match, model, score, spatial
from leasegrid.operators.panel import time_lags
from leasegrid.plans import rent_growth
from leasegrid.queries.registry import CUSTOMERS, SUPPLIERS, cents, customers, haversine_sql, query, suppliers, table
from leasegrid.queries.tables import EVENT_TYPES, QTR, SERIES, segment_series
from leasegrid.session import cut_lineage, shared_path
from leasegrid.streaming import ingest

# --- distance joins -------------------------------------------------------------------

KM = haversine_sql("c", "s")
PAIRS = f"SELECT c_custkey, s_suppkey, s_name, c_nationkey, s_nationkey, {KM} AS km FROM ({CUSTOMERS}) c, ({SUPPLIERS}) s"


@query(
    "knn_join",
    f"""SELECT c_custkey, s_suppkey, round(km, 6) AS distance, CAST(row_number() OVER (PARTITION BY c_custkey ORDER BY km, s_suppkey) AS INTEGER) AS rank
    FROM ({PAIRS}) WHERE km <= 40 QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY km, s_suppkey) <= 10""",
)
def knn_join(spark, sf):
    out = spatial.nearest(customers(spark, sf), suppliers(spark, sf), 10, "c_custkey", "s_suppkey", within=40.0)
    return out.withColumn("distance", F.round("distance", 6))


@query(
    "cheapest_station",
    f"""SELECT c_custkey, s_suppkey, round(km, 6) AS distance FROM (SELECT * FROM ({PAIRS}) WHERE km <= 40 QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY km, s_suppkey) <= 10)
    QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY (s_suppkey * 37) % 101, s_suppkey) = 1""",
)
def cheapest_station(spark, sf):
    near = spatial.nearest(customers(spark, sf), suppliers(spark, sf), 10, "c_custkey", "s_suppkey", within=40.0)
    timed = near.withColumn("seconds", F.col("s_suppkey") * 37 % 101)
    return spatial.cheapest_candidate(timed, "c_custkey", "seconds", "s_suppkey").select("c_custkey", "s_suppkey", F.round("distance", 6).alias("distance"))


@query("radius_join", f"SELECT c_custkey, s_suppkey, round(km, 6) AS distance FROM ({PAIRS}) WHERE km <= 8")
def radius_join(spark, sf):
    out = spatial.within_radius(customers(spark, sf), suppliers(spark, sf), 8.0)
    return out.select("c_custkey", "s_suppkey", F.round("distance", 6).alias("distance"))


@query(
    "amenity_summary",
    f"""WITH p AS (SELECT c_custkey, km, CASE s_nationkey % 3 WHEN 0 THEN 'cafe' WHEN 1 THEN 'bank' ELSE 'prison' END AS amenity FROM ({PAIRS}) WHERE km <= 12)
    SELECT c_custkey, cafes AS count_cafe, dc AS min_dist_cafe, banks AS count_bank, db AS min_dist_bank FROM customer LEFT JOIN (
      SELECT c_custkey AS k, count(*) FILTER (WHERE amenity = 'cafe') AS cafes, round(min(km) FILTER (WHERE amenity = 'cafe') * 1000, 3) AS dc,
      count(*) FILTER (WHERE amenity = 'bank') AS banks, round(min(km) FILTER (WHERE amenity = 'bank') * 1000, 3) AS db FROM p WHERE amenity IN ('cafe', 'bank') GROUP BY 1) ON k = c_custkey""",
)
def amenity_summary(spark, sf):
    kind = F.element_at(F.array(F.lit("cafe"), F.lit("bank"), F.lit("prison")), (F.col("s_nationkey") % 3 + 1).cast("int"))
    pois = suppliers(spark, sf).select(F.col("s_name").alias("name"), kind.alias("amenity"), "lat", "lon")
    out = spatial.amenities_near(customers(spark, sf), pois, "c_custkey", "cafe|bank", ["cafe", "bank"], 12.0, "haversine")
    return out.withColumns({c: F.round(c, 3) for c in ("min_dist_cafe", "min_dist_bank")})


EDGES = f"""SELECT src, dst, max(w) AS w FROM (SELECT a AS src, b AS dst, w FROM e UNION ALL SELECT b, a, w FROM e) GROUP BY 1, 2"""


def _edges_sql(k, extra=""):
    km = haversine_sql("x", "y")
    return f"""WITH s AS ({SUPPLIERS}), d AS (SELECT x.s_name AS a, y.s_name AS b, {km} AS km FROM s x, s y WHERE x.s_name <> y.s_name),
    r AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY km, b) AS r FROM d), e AS (SELECT a, b, 1 / (km + 1e-4) AS w FROM r WHERE r <= {k} AND km > 0), edges AS ({EDGES}){extra}"""


def _places(spark, sf):
    return suppliers(spark, sf).select(F.col("s_name").alias("locality"), "lat", "lon", "s_nationkey")


@query("knn_self_weights", _edges_sql(15) + " SELECT src, dst, round(w, 8) AS w FROM edges")
def knn_self_weights(spark, sf):
    return spatial.neighbour_weights(_places(spark, sf)).withColumn("w", F.round("w", 8))


@query(
    "w_rows",
    _edges_sql(5, ", p AS (SELECT s_name AS unit, s_name AS part FROM s UNION ALL SELECT a.s_name || '-' || b.s_name, unnest([a.s_name, b.s_name]) FROM s a JOIN s b ON b.s_suppkey = a.s_suppkey + 1)")
    + """, c AS (SELECT i.unit AS src, j.unit AS dst, sum(w) AS w FROM edges JOIN p i ON i.part = src JOIN p j ON j.part = dst GROUP BY 1, 2)
    SELECT src, dst, round(w / sum(w) OVER (PARTITION BY src), 8) AS w FROM c""",
)
def w_rows(spark, sf):
    places = _places(spark, sf)
    s = suppliers(spark, sf).select("s_suppkey", F.col("s_name").alias("a"))
    nxt = s.select((F.col("s_suppkey") - 1).alias("s_suppkey"), F.col("a").alias("b"))
    combos = s.join(nxt, "s_suppkey").select(F.concat_ws("-", "a", "b").alias("suburb"))
    lost = s.select(F.concat(F.col("a"), F.lit("-nowhere")).alias("suburb"))
    units = places.select(F.col("locality").alias("suburb")).unionByName(combos).unionByName(lost)
    edges = spatial.combo_weights(spatial.neighbour_weights(places, k=5), places, units)
    return spatial.row_stochastic(edges).withColumn("w", F.round("w", 8))


@query(
    "sparsity",
    _edges_sql(5) + " SELECT count(*) AS nonzero, (SELECT count(*) FROM s) AS n, round(1 - count(*) / ((SELECT count(*) FROM s) * (SELECT count(*) FROM s)), 8) AS sparsity FROM edges",
)
def sparsity(spark, sf):
    places = _places(spark, sf)
    return spatial.sparsity(spatial.neighbour_weights(places, k=5), places, "locality").withColumn("sparsity", F.round("sparsity", 8))


@query(
    "spatial_lag",
    _edges_sql(4)
    + f""", y AS (SELECT s_name AS suburb, {QTR.format(d='l_shipdate')}, avg(l_extendedprice) AS v FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2, 3),
    g AS (SELECT src, year, quarter, sum(w * v) / sum(w) AS lag FROM edges JOIN y ON y.suburb = dst GROUP BY 1, 2, 3)
    SELECT y.suburb, y.year, y.quarter, round(coalesce(lag, 0), 4) AS spatial_lag FROM y LEFT JOIN g ON g.src = y.suburb AND g.year = y.year AND g.quarter = y.quarter""",
)
def spatial_lag(spark, sf):
    l = table(spark, sf, "lineitem").join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    y = l.groupBy(F.col("s_name").alias("suburb"), F.year("l_shipdate").alias("year"), F.quarter("l_shipdate").alias("quarter")).agg(F.avg("l_extendedprice").alias("v"))
    y = y.withColumn("t", F.col("year") * 4 + F.col("quarter"))
    edges = spatial.neighbour_weights(_places(spark, sf), k=4)
    out = joins.spatial_lag(y, edges, "t", "v")
    return out.select("suburb", "year", "quarter", F.round("spatial_lag", 4).alias("spatial_lag"))


GAPPED = f"SELECT c_custkey, c_nationkey, lat, lon, CASE WHEN c_acctbal > 0 AND c_nationkey <> 5 THEN c_acctbal END AS a, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal * 2 END AS b FROM ({CUSTOMERS})"


@query(
    "nearest_donor",
    f"""WITH t AS ({GAPPED}), g AS (SELECT * FROM t WHERE a IS NOT NULL AND b IS NOT NULL), n AS (SELECT * FROM t WHERE a IS NULL OR b IS NULL),
    own AS (SELECT n.c_custkey, g.a, g.b, sqrt((g.lat - n.lat) * (g.lat - n.lat) + (g.lon - n.lon) * (g.lon - n.lon)) AS d, g.c_custkey AS k FROM n JOIN g USING (c_nationkey)),
    far AS (SELECT n.c_custkey, g.a, g.b, sqrt((g.lat - n.lat) * (g.lat - n.lat) + (g.lon - n.lon) * (g.lon - n.lon)) AS d, g.c_custkey AS k FROM n, g WHERE n.c_nationkey NOT IN (SELECT c_nationkey FROM g)),
    pick AS (SELECT * FROM (SELECT * FROM own UNION ALL SELECT * FROM far) QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY d, k) = 1)
    SELECT t.c_custkey, coalesce(t.a, p.a) AS a_imputed, coalesce(t.b, p.b) AS b_imputed FROM t LEFT JOIN pick p USING (c_custkey)""",
)
def nearest_donor(spark, sf):
    c = customers(spark, sf).select(
        "c_custkey", "c_nationkey", "lat", "lon",
        F.when((F.col("c_acctbal") > 0) & (F.col("c_nationkey") != 5), F.col("c_acctbal")).alias("a"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal") * 2).alias("b"),
    )
    out = spatial.impute_nearest(c, ["a", "b"], "c_custkey", "c_nationkey", suffix="_imputed")
    return out.select("c_custkey", "a_imputed", "b_imputed")


# Around each supplier: a square with a square hole, two diamonds as parts, or one diamond.
def _shapes(spark, sf):
    s = suppliers(spark, sf)
    r = F.lit(0.03) + F.col("s_nationkey") / 200.0
    corners = [(-1, 0), (0, -1), (1, 0), (0, 1), (-1, 0)]
    box = [(-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1)]

    def ring(outline, size=1.0, east=0.0):
        spots = [F.struct((F.col("lon") + r * (dx * size + east)).alias("x"), (F.col("lat") + r * (dy * size)).alias("y")) for dx, dy in outline]
        return F.array(*spots)

    kind = F.col("s_nationkey") % 3
    shape = (
        F.when(kind == 0, F.array(F.array(ring(box), ring(box, 0.5))))
        .when(kind == 1, F.array(F.array(ring(corners)), F.array(ring(corners, 0.5, 2.0))))
        .otherwise(F.array(F.array(ring(corners))))
    )
    return s.select("s_suppkey", "s_nationkey", F.col("lat").alias("listing_lat"), F.col("lon").alias("listing_lon"), shape.alias("ring"))


INSIDE = """CASE s_nationkey % 3 WHEN 0 THEN greatest(abs(c.lon - s.lon), abs(c.lat - s.lat)) BETWEEN r / 2 AND r
    WHEN 1 THEN abs(c.lon - s.lon) + abs(c.lat - s.lat) <= r OR abs(c.lon - s.lon - 2 * r) + abs(c.lat - s.lat) <= r / 2
    ELSE abs(c.lon - s.lon) + abs(c.lat - s.lat) <= r END"""
RINGS = f"SELECT *, 0.03e0 + s_nationkey / 200e0 AS r FROM ({SUPPLIERS})"


@query("point_in_polygon", f"SELECT s_suppkey, c_custkey FROM ({RINGS}) s, ({CUSTOMERS}) c WHERE {INSIDE}")
def point_in_polygon(spark, sf):
    points = customers(spark, sf).select("c_custkey", "lat", "lon")
    return spatial.points_in_polygons(_shapes(spark, sf), points).select("s_suppkey", "c_custkey")


@query(
    "best_school",
    f"""WITH f AS (SELECT s_suppkey, c_name, round(c_acctbal / 10000, 4) / (1 + 0.2e0 * ({KM})) AS score, {KM} AS km FROM ({RINGS}) s, ({CUSTOMERS}) c WHERE {INSIDE} AND (c_mktsegment = 'BUILDING' OR 2000 + c_nationkey <= 2000 + s_nationkey)),
    b AS (SELECT s_suppkey, count(*) AS n_schools, arg_max(c_name, (score, c_name)) AS best_school_name, max(score) AS best_score, arg_max(km, (score, c_name)) AS best_dist_km FROM f GROUP BY 1)
    SELECT s.s_suppkey, b.best_school_name, round(b.best_score, 6) AS best_score, round(b.best_dist_km, 6) AS best_dist_km, b.n_schools FROM supplier s LEFT JOIN b USING (s_suppkey)""",
)
def best_school(spark, sf):
    schools = customers(spark, sf).select(
        F.col("c_name").alias("school_name"), F.round(F.col("c_acctbal") / 10000, 4).alias("school_goodness"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_nationkey") + 2000).alias("establishment_year"), "lat", "lon",
    )
    bands = _shapes(spark, sf).withColumns({"band": F.lit("walking_5min"), "year": F.col("s_nationkey") + 2000})
    out = spatial.best_schools(bands, schools, "s_suppkey", method="haversine")
    return out.select("s_suppkey", "best_school_name", F.round("best_score", 6).alias("best_score"), F.round("best_dist_km", 6).alias("best_dist_km"), "n_schools")


@query(
    "wkt_rings",
    """SELECT s_suppkey, CASE s_nationkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 2 END AS parts, CASE s_nationkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 END AS rings,
    CASE s_nationkey % 5 WHEN 0 THEN 4 WHEN 1 THEN 10 WHEN 2 THEN 14 END AS corners, CASE WHEN s_nationkey % 5 < 3 THEN round(s_acctbal, 2) END AS first_x,
    round(CASE s_nationkey % 5 WHEN 0 THEN s_acctbal + 1 WHEN 1 THEN s_acctbal + 10 WHEN 2 THEN s_acctbal + 33 END, 2) AS last_x FROM supplier""",
)
def wkt_rings(spark, sf):
    x = F.round("s_acctbal", 2)
    at = lambda d: F.format_string("%.2f", x + d)

    def ring(*offsets):
        return F.concat(F.lit("("), F.concat_ws(", ", *[F.concat(at(dx), F.lit(f" {dy}")) for dx, dy in offsets]), F.lit(")"))

    small = ring((0, 0), (1, "5e-1"), (1, 1), (0, 0))
    large = ring((0, 0), (10, 0), (10, 10), (0, 10), (0, 0))
    hole = ring((2, 2), (4, 2), (4, 4), (2, 4), (2, 2))
    far = ring((30, 0), (33, 0), (33, "1.5"), (30, 0))
    kind = F.col("s_nationkey") % 5
    text = (
        F.when(kind == 0, F.concat(F.lit("POLYGON Z ("), F.regexp_replace(small, r" (\S+?)([,)])", " $1 7$2"), F.lit(")")))
        .when(kind == 1, F.concat(F.lit(" polygon("), large, F.lit(" , "), hole, F.lit(")")))
        .when(kind == 2, F.concat(F.lit("MULTIPOLYGON ((("), F.substring(large, 2, 999), F.lit(", "), hole, F.lit("), ("), far, F.lit("))")))
        .when(kind == 3, F.lit("MULTIPOLYGON EMPTY"))
        .otherwise(F.concat(F.lit("POLYGON (("), at(0), F.lit(" 0, 1 1, 2 2, 9 9))")))
    )
    # parsing costs far more than the few bytes of a row tell, so file splits do not set the tasks
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shapes = table(spark, sf, "supplier").repartition(spread).select("s_suppkey", wkt_shape(text).alias("shape"))
    points = F.flatten(F.flatten("shape"))
    return shapes.select(
        "s_suppkey", F.size("shape").alias("parts"), F.size(F.flatten("shape")).alias("rings"), F.size(points).alias("corners"),
        F.get(points, F.lit(0)).x.alias("first_x"), F.round(F.array_max(F.transform(points, lambda p: p.x)), 2).alias("last_x"),
    ).withColumns({c: F.when(F.col(c) >= 0, F.col(c)) for c in ("parts", "rings", "corners")})


@query(
    "stop_groups",
    f"SELECT s_nationkey, count(*) AS num_stops, arg_min(lat, s_suppkey) AS lat, arg_min(lon, s_suppkey) AS lon FROM ({SUPPLIERS}) GROUP BY 1",
)
def stop_groups(spark, sf):
    return spatial.first_geometry(suppliers(spark, sf), ["s_nationkey"], ["lat", "lon"], "s_suppkey")


# --- names ---------------------------------------------------------------------------

EDIT = "1 - levenshtein(a.u, b.u) / greatest(length(a.u), length(b.u))"


@query(
    "fuzzy_dedup",
    f"""WITH p AS (SELECT page_id, url AS u, substr(url, 1, 5) AS scheme FROM pages)
    SELECT page_id, u AS url FROM p a WHERE NOT EXISTS (SELECT 1 FROM p b WHERE b.page_id < a.page_id AND b.scheme = a.scheme AND {EDIT} >= 0.9)""",
)
def fuzzy_dedup(spark, sf):
    p = table(spark, sf, "pages").select("page_id", "url", F.substring("url", 1, 5).alias("scheme"))
    return match.fuzzy_dedup(p, "url", ["scheme"], ["page_id"], 0.9).select("page_id", "url")


@query(
    "fuzzy_top1",
    f"""WITH k AS (SELECT p_name AS u, max(p_partkey) AS v FROM part GROUP BY 1),
    a AS (SELECT DISTINCT p_name || CASE WHEN p_size > 25 THEN ' x' ELSE '' END AS u FROM part),
    m AS (SELECT a.u AS asked, arg_max(b.v, ({EDIT}, b.u)) AS v FROM a JOIN k b ON {EDIT} >= 0.85 GROUP BY 1)
    SELECT p_partkey, v AS matched FROM part LEFT JOIN m ON asked = p_name || CASE WHEN p_size > 25 THEN ' x' ELSE '' END""",
)
def fuzzy_top1(spark, sf):
    p = table(spark, sf, "part")
    asked = p.select("p_partkey", F.concat("p_name", F.when(F.col("p_size") > 25, " x").otherwise("")).alias("u"))
    names = p.select(F.col("p_name").alias("n"), F.col("p_partkey").alias("matched"))
    return match.match_names(asked, names, "u", "n", "matched", 0.85).select("p_partkey", "matched")


@query(
    "similar_names",
    f"""WITH s AS (SELECT DISTINCT url AS u FROM pages) SELECT a.u AS text, b.u AS match, round({EDIT}, 8) AS similarity FROM s a, s b WHERE {EDIT} >= 0.8""",
)
def similar_names(spark, sf):
    p = table(spark, sf, "pages").select(F.col("url").alias("text"))
    return match.similar_pairs(p, p, 0.8).withColumn("similarity", F.round("similarity", 8))


@query(
    "school_ranks",
    f"""WITH k AS (SELECT lower(p_name) || ' college' AS u, max(p_size * 2) AS v FROM part GROUP BY 1),
    a AS (SELECT DISTINCT lower(p_name) || CASE WHEN p_size > 40 THEN ' coll' ELSE ' college' END AS u FROM part),
    m AS (SELECT a.u AS asked, arg_max(b.v, ({EDIT}, b.u)) AS v FROM a JOIN k b ON {EDIT} >= 0.85 GROUP BY 1)
    SELECT p_partkey, coalesce(v, CASE WHEN p_size > 10 THEN 101 END) AS vic_secondary_rank FROM part LEFT JOIN m ON asked = lower(p_name) || CASE WHEN p_size > 40 THEN ' coll' ELSE ' college' END""",
)
def school_ranks(spark, sf):
    s = table(spark, sf, "part").select("p_partkey", F.concat(F.initcap("p_name"), F.when(F.col("p_size") > 40, " Coll").otherwise(" College")).alias("school_name"), F.when(F.col("p_size") > 10, "Secondary").otherwise("Primary").alias("school_type"))
    ranks = table(spark, sf, "part").select(F.concat(F.initcap("p_name"), F.lit(" College, Main Campus")).alias("school_name"), (F.col("p_size") * 2).alias("vic_secondary_rank"))
    return match.rank_schools(s, ranks).select("p_partkey", "vic_secondary_rank")


# Schools of one place: names almost alike, coordinates equal to one decimal.
@query(
    "fuzzy_dedup_places",
    f"""WITH p AS (SELECT c_custkey, c_name || CASE WHEN c_custkey % 3 = 0 THEN ' school' ELSE ' schol' END AS u, round(lat, 1) AS x, round(lon, 1) AS y FROM ({CUSTOMERS}))
    SELECT c_custkey, u AS name FROM p a WHERE NOT EXISTS (SELECT 1 FROM p b WHERE b.c_custkey < a.c_custkey AND b.x = a.x AND b.y = a.y AND {EDIT} >= 0.9)""",
)
def fuzzy_dedup_places(spark, sf):
    named = F.concat("c_name", F.when(F.col("c_custkey") % 3 == 0, " school").otherwise(" schol"))
    p = customers(spark, sf).select("c_custkey", named.alias("name"), F.round("lat", 1).alias("x"), F.round("lon", 1).alias("y"))
    return match.fuzzy_dedup(p, "name", ["x", "y"], ["c_custkey"], 0.9).select("c_custkey", "name")


# --- scores ----------------------------------------------------------------------------

SHAPES = "SELECT n_nationkey AS suburb, count(*) AS count_cafe, avg(s_acctbal) AS min_dist_cafe, min(s_acctbal) AS income_rent_ratio FROM nation JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1"
_UNIT = "CASE WHEN max({x}) OVER () - min({x}) OVER () <= 1e-8 + 1e-5 * abs(max({x}) OVER ()) THEN 0.5e0 ELSE (({x}) - min({x}) OVER ()) / (max({x}) OVER () - min({x}) OVER ()) END"


def _suburb_shapes(spark, sf):
    s = table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("suburb"))
    return s.agg(F.count("*").alias("count_cafe"), F.avg("s_acctbal").alias("min_dist_cafe"), F.min("s_acctbal").alias("income_rent_ratio"))


@query(
    "pillar_score",
    f"""WITH s AS ({SHAPES}), f AS (SELECT suburb, {_UNIT.format(x='count_cafe')} AS a, {_UNIT.format(x='1 / (1 + greatest(min_dist_cafe, 0))')} AS b, {_UNIT.format(x='1 / nullif(income_rent_ratio, 0)')} AS c, {_UNIT.format(x='income_rent_ratio')} AS d FROM s)
    SELECT suburb, round((a + b) / 2, 6) AS pillar_e, round((c + d) / 2, 6) AS pillar_c, 0.5e0 AS pillar_x, round(0.6e0 * (a + b) / 2 - 0.1e0 * (c + d) / 2, 6) AS score FROM f""",
)
def pillar_score(spark, sf):
    s = _suburb_shapes(spark, sf).withColumn("flat", F.lit(3.0))
    config = {
        "E": {"count": ["count_cafe", "count_absent"], "distance": ["min_dist_cafe"]},
        "C": {"inverse": ["income_rent_ratio"], "direct": ["income_rent_ratio"]},
        "X": {"direct": ["flat"]},
    }
    out = score.livability(score.pillar_scores(s, config), {"E": 0.6, "C": -0.1}, "score")
    return out.select("suburb", *[F.round(c, 6).alias(c) for c in ("pillar_e", "pillar_c", "pillar_x", "score")])


def _suburb_features(spark, sf):
    """A table with every pillar's columns, from event types and values per user."""
    from leasegrid.constants import PILLARS

    names = sorted({b for cfg in PILLARS.values() for bases in cfg.values() for b in bases})
    e = table(spark, sf, "events")
    hit = lambda i: f"IF(event_type = '{EVENT_TYPES[i % 5]}', value + {i}, NULL)"
    fn = lambda n: "count" if n.startswith(("count_", "n_")) else "avg"
    aggs = [F.expr(f"{fn(n)}({hit(i)}) AS `{n}`") for i, n in enumerate(names)]
    return e.groupBy(F.col("user_id").alias("suburb")).agg(*aggs)


def _liveability_sql():
    from leasegrid.constants import PILLAR_WEIGHTS, PILLARS

    names = sorted({b for cfg in PILLARS.values() for bases in cfg.values() for b in bases})
    cols, feats, scores = [], [], {}
    for i, n in enumerate(names):
        agg = "count" if n.startswith(("count_", "n_")) else "avg"
        cols.append(f"{agg}(value + {i}) FILTER (WHERE event_type = '{EVENT_TYPES[i % 5]}') AS c{i}")
    shape = {"count": "coalesce({c}, 0)", "distance": "1 / (1 + greatest({c}, 0))", "inverse": "1 / nullif({c}, 0)", "direct": "{c}"}
    for p, cfg in PILLARS.items():
        mine = []
        for kind, bases in cfg.items():
            for b in bases:
                x = shape[kind].format(c=f"c{names.index(b)}")
                if kind == "distance":
                    x = f"CASE WHEN c{names.index(b)} IS NOT NULL THEN {x} END"
                f = f"f{len(feats)}"
                feats.append(f"{_UNIT.format(x=x)} AS {f}")
                mine.append(f)
        scores[p] = f"list_avg([{', '.join(mine)}])"
    total = " + ".join(f"({w}e0) * ({scores[p]})" for p, w in PILLAR_WEIGHTS.items())
    return f"""WITH a AS (SELECT user_id AS suburb, {', '.join(cols)} FROM events GROUP BY 1), f AS (SELECT suburb, {', '.join(feats)} FROM a)
    SELECT suburb, {', '.join(f'round({s}, 6) AS pillar_{p.lower()}' for p, s in scores.items())}, round({total}, 6) AS livability_score FROM f"""


@query("livability", _liveability_sql())
def livability(spark, sf):
    out = score.livability(score.pillar_scores(_suburb_features(spark, sf)))
    return out.select("suburb", *[F.round(c, 6).alias(c) for c in out.columns if c.startswith("pillar_")], F.round("livability_score", 6).alias("livability_score"))


@query(
    "affordability",
    """WITH r AS (SELECT lower(n_name) AS suburb, avg(s_acctbal) AS rent FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1), i AS (SELECT lower(n_name) AS suburb, avg(c_acctbal) AS income FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)
    SELECT suburb, round(rent / income, 8) AS income_rent_ratio FROM r JOIN i USING (suburb)""",
)
def affordability(spark, sf):
    n = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("suburb"))

    def mean(name, key, value, out):
        t = table(spark, sf, name).join(n, F.col(key) == F.col("n_nationkey"))
        return t.groupBy("suburb").agg(F.avg(value).alias(out))

    rents = mean("supplier", "s_nationkey", "s_acctbal", "median_rent_census")
    incomes = mean("customer", "c_nationkey", "c_acctbal", "median_household_income")
    out = score.affordability(n.select(F.lower("suburb").alias("suburb")), rents, incomes)
    return out.select("suburb", F.round("income_rent_ratio", 8).alias("income_rent_ratio"))


# --- models ---------------------------------------------------------------------------


@query(
    "regression_metrics",
    """WITH t AS (SELECT l_linestatus AS split, l_extendedprice AS y, l_quantity * 2000 AS p FROM lineitem)
    SELECT split, round(sqrt(avg((y - p) * (y - p))), 4) AS rmse, round(avg(abs(y - p)), 4) AS mae, round(quantile_cont(abs(y - p), 0.5), 4) AS median_ae, round(1 - avg((y - p) * (y - p)) / var_pop(y), 8) AS r2,
    round(avg(abs(y - p) / abs(y)), 6) AS mape, round(avg(2 * abs(y - p) / (abs(y) + abs(p) + 1e-12)), 8) AS smape FROM t GROUP BY 1""",
)
def regression_metrics(spark, sf):
    l = table(spark, sf, "lineitem").select(F.col("l_linestatus").alias("split"), F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 2000).alias("p"))
    out = model.regression_metrics(l, "y", "p", "split")
    digits = {"rmse": 4, "mae": 4, "median_ae": 4, "r2": 8, "mape": 6, "smape": 8}
    return out.select("split", *[F.round(c, d).alias(c) for c, d in digits.items()])


@query(
    "generalisation_gap",
    """WITH m AS (SELECT l_linestatus AS s, 1 - avg((l_extendedprice - l_quantity * 2000) * (l_extendedprice - l_quantity * 2000)) / var_pop(l_extendedprice) AS r2 FROM lineitem GROUP BY 1)
    SELECT round((SELECT r2 FROM m WHERE s = 'O') - (SELECT r2 FROM m WHERE s = 'F'), 8) AS r2_gap""",
)
def generalisation_gap(spark, sf):
    l = table(spark, sf, "lineitem").select(F.col("l_linestatus").alias("split"), F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 2000).alias("p"))
    gap = model.generalisation_gap(model.regression_metrics(l, "y", "p", "split"), train="O", test="F")
    return gap.withColumn("r2_gap", F.round("r2_gap", 8))


# errors of a simple regression from its sums: n, mean and square sum of x, residual sum of squares
_OLS = """WITH t AS ({rows}), s AS (SELECT sum(w) AS sw, count(*) AS n, sum(w * x) / sum(w) AS mx, sum(w * y) / sum(w) AS my FROM t),
c AS (SELECT n, sw, mx, my, sum(w * (x - mx) * (x - mx)) AS sxx, sum(w * (x - mx) * (y - my)) AS sxy, sum(w * (y - my) * (y - my)) AS syy FROM t, s GROUP BY ALL),
b AS (SELECT *, sxy / sxx AS slope, my - sxy / sxx * mx AS icept, (syy - sxy * sxy / sxx) / (n - 2) AS s2, sxy * sxy / sxx / syy AS fitted FROM c),
o AS (SELECT 'const' AS feature, icept AS coefficient, sqrt(s2 * (1 / sw + mx * mx / sxx)) AS std_error, fitted AS r2 FROM b UNION ALL SELECT '{x}', slope, sqrt(s2 / sxx), fitted FROM b)"""
_LINE_ROWS = "SELECT l_quantity AS x, l_extendedprice AS y, {w} AS w FROM lineitem"


@query("ols", _OLS.format(rows=_LINE_ROWS.format(w="1e0"), x="l_quantity") + " SELECT feature, round(coefficient, 3) AS coefficient, round(std_error, 4) AS std_error, round(r2, 8) AS r2 FROM o")
def ols(spark, sf):
    fit = linear.least_squares(table(spark, sf, "lineitem"), ["l_quantity"], "l_extendedprice")
    return fit.table(spark).select("feature", F.round("coefficient", 3).alias("coefficient"), F.round("std_error", 4).alias("std_error"), F.round(F.lit(float(fit.r2)), 8).alias("r2"))


@query("wls", _OLS.format(rows=_LINE_ROWS.format(w="1 + l_tax * 10"), x="l_quantity") + " SELECT feature, round(coefficient, 3) AS coefficient, round(std_error, 4) AS std_error FROM o")
def wls(spark, sf):
    l = table(spark, sf, "lineitem").withColumn("w", 1 + F.col("l_tax") * 10)
    fit = linear.least_squares(l, ["l_quantity"], "l_extendedprice", "w")
    return fit.table(spark).select("feature", F.round("coefficient", 3).alias("coefficient"), F.round("std_error", 4).alias("std_error"))


# Five regions leave three degrees of freedom, where the t distribution has a closed form.
_REGIONS = "SELECT avg(c_acctbal) AS y, 1000 * avg(CASE WHEN c_mktsegment = 'BUILDING' THEN 1e0 ELSE 0e0 END) AS x, 1e0 AS w FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_regionkey"


@query(
    "ols_p_values",
    _OLS.format(rows=_REGIONS, x="building")
    + """ SELECT feature, round(coefficient, 4) AS coefficient, round(std_error, 4) AS std_error, round(1 - 2 / pi() * (atan(t / sqrt(3e0)) + t / sqrt(3e0) / (1 + t * t / 3)), 8) AS p_value
    FROM (SELECT *, abs(coefficient / std_error) AS t FROM o)""",
)
def ols_p_values(spark, sf):
    c = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    share = 1000 * F.avg(F.when(F.col("c_mktsegment") == "BUILDING", 1.0).otherwise(0.0))
    rows = c.groupBy("n_regionkey").agg(F.avg("c_acctbal").alias("balance"), share.alias("building"))
    fit = linear.least_squares(rows, ["building"], "balance").table(spark)
    return fit.select("feature", F.round("coefficient", 4).alias("coefficient"), F.round("std_error", 4).alias("std_error"), F.round("p_value", 8).alias("p_value"))


_LINE_ORDER = ["l_shipdate", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


@query("lasso")
def lasso(spark, sf):
    l = table(spark, sf, "lineitem").withColumn("noise", F.pmod(F.xxhash64("l_partkey", "l_suppkey"), F.lit(1000)) / 1000.0)
    fit = linear.lasso_select(l, ["l_quantity", "l_discount", "l_tax", "noise"], "l_extendedprice", _LINE_ORDER)
    rows = [(k, v, fit.penalty, fit.converged) for k, v in fit.coefficients.items()]
    return spark.createDataFrame(rows, "feature string, coefficient double, penalty double, converged boolean")


# One standardised feature: the coefficient is the covariance moved towards zero by the penalty.
@query(
    "lasso_one_feature",
    f"""WITH t AS (SELECT l_quantity AS x, l_extendedprice AS y, row_number() OVER (ORDER BY {', '.join(_LINE_ORDER)}) AS i, count(*) OVER () AS n, avg(l_quantity) OVER () AS m, stddev_pop(l_quantity) OVER () AS s FROM lineitem),
    z AS (SELECT (x - m) / s AS z, y, CASE WHEN i <= n - 3 * (n // 4) THEN 0 ELSE CAST(ceil((i - n + 3 * (n // 4)) / (n // 4)::DOUBLE) AS INTEGER) END AS seg FROM t),
    c AS (SELECT covar_pop(y, z) AS c FROM z), a AS (SELECT k, abs(c) * power(1e-3, k / 99e0) AS a FROM c, range(100) r(k)),
    f AS (SELECT f, avg(z) AS mz, avg(y) AS my, var_pop(z) AS v, covar_pop(y, z) AS c FROM z JOIN range(1, 4) q(f) ON seg < f GROUP BY f),
    h AS (SELECT seg AS f, avg(z) AS hz, avg(y) AS hy, var_pop(z) AS hv, var_pop(y) AS hw, covar_pop(y, z) AS hc FROM z WHERE seg > 0 GROUP BY seg),
    w AS (SELECT *, sign(c) * greatest(abs(c) - a, 0) / v AS w FROM f JOIN h USING (f), a),
    e AS (SELECT k, a, avg(hw + (hy - my) * (hy - my) - 2 * w * (hc + (hy - my) * (hz - mz)) + w * w * (hv + (hz - mz) * (hz - mz))) AS e FROM w GROUP BY k, a),
    b AS (SELECT arg_min(a, (e, k)) AS a, min(e) AS e FROM e)
    SELECT round(b.a, 3) AS penalty, round(sign(c) * (abs(c) - b.a), 3) AS coefficient, round(b.e, 2) AS error, true AS converged FROM b, c""",
)
def lasso_one_feature(spark, sf):
    fit = linear.lasso_select(table(spark, sf, "lineitem"), ["l_quantity"], "l_extendedprice", _LINE_ORDER)
    row = (round(fit.penalty, 3), round(fit.coefficients["l_quantity"], 3), round(min(fit.errors), 2), fit.converged)
    return spark.createDataFrame([row], "penalty double, coefficient double, error double, converged boolean")


@query(
    "target_encoding",
    """WITH s AS (SELECT avg(o_totalprice) AS m, var_pop(o_totalprice) AS v FROM orders), g AS (SELECT o_custkey, count(*) AS n, avg(o_totalprice) AS m, var_pop(o_totalprice) AS v FROM orders GROUP BY 1)
    SELECT c_custkey, round(coalesce(s.v * g.n / (s.v * g.n + g.v) * g.m + (1 - s.v * g.n / (s.v * g.n + g.v)) * s.m, s.m), 4) AS encoded FROM customer CROSS JOIN s LEFT JOIN g ON o_custkey = c_custkey""",
)
def target_encoding(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_totalprice")
    enc, prior = model.target_encoding(o, "c_custkey", "o_totalprice")
    out = model.apply_target_encoding(table(spark, sf, "customer").select("c_custkey"), enc, "c_custkey", prior)
    return out.select("c_custkey", F.round("c_custkey_encoded", 4).alias("encoded"))


def _tree_rows(spark, sf):
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_discount", "l_tax", "l_returnflag", F.log1p("l_extendedprice").alias("y"))
    l = clean.hash_split(l, "l_orderkey", {"train": 0.45, "val": 0.15, "test": 0.4})
    # a fit passes over its rows many times; they are hashed once
    return cut_lineage(l.withColumn("is_val", F.col("split") == "val").drop("l_orderkey", "l_partkey"))


@query("boosted_trees")
def boosted_trees(spark, sf):
    rows = _tree_rows(spark, sf)
    known = rows.where(F.col("split") != "test")
    stages = model.preprocessor(known, ["l_quantity", "l_discount", "l_tax"], ["l_returnflag"])
    stages.append(model.boosted_trees("y", validation="is_val", maxIter=10, maxDepth=4, stepSize=0.3))
    fitted = Pipeline(stages=stages).fit(known)
    scored = fitted.transform(rows).select("split", F.expm1("y").alias("price"), F.expm1("prediction").alias("predicted"))
    return model.regression_metrics(cut_lineage(scored), "price", "predicted", "split")


@query("random_search")
def random_search(spark, sf):
    rows = _tree_rows(spark, sf)
    known = rows.where(F.col("split") != "test")
    # up to the default 1,000 rounds; a fit ends when another one is worse on the validation rows
    gbt = model.boosted_trees("y", validation="is_val", validationTol=0.0)
    stages = model.preprocessor(known, ["l_quantity", "l_discount"], [])
    space = {"maxDepth": [2, 3, 4, 6], "stepSize": [0.05, 0.1, 0.3]}
    cv = model.random_search(known, Pipeline(stages=[*stages, gbt]), gbt, space, model.OriginalScaleRmse("y"))
    scored = cv.bestModel.transform(rows)
    return model.importances(cv.bestModel, scored).withColumn("rmse", F.lit(float(min(cv.avgMetrics))))


@query(
    "log_features",
    f"""WITH s AS ({SERIES}), l AS (SELECT *, lag(price) OVER (PARTITION BY unit ORDER BY date) AS lag_1 FROM s)
    SELECT unit, date, round(ln(price), 8) AS log_price, round(ln(lag_1), 8) AS log_lag_1, round(CASE WHEN quarter = 1 THEN ln(1e-10) ELSE ln(price + 1e-10) END, 8) AS log_spatial_lag FROM l WHERE lag_1 IS NOT NULL""",
)
def log_features(spark, sf):
    s = time_lags(segment_series(spark, sf), ["unit"], "date", "price", [1], "lag_")
    s = s.withColumn("spatial_lag", F.when(F.col("quarter") == 1, 0.0).otherwise(F.col("price")))
    out = model.log_features(s, "price", ["lag_1"])
    return out.select("unit", "date", *[F.round(c, 8).alias(c) for c in ("log_price", "log_lag_1", "log_spatial_lag")])


# --- forecasts ---------------------------------------------------------------------------


@query("var_forecast")
def var_forecast(spark, sf):
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    q = o.groupBy("c_mktsegment", F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("quarter")).agg(
        F.avg("o_totalprice").alias("price_index"), F.avg("c_acctbal").alias("balance")
    )
    return forecast.var_forecast(q, ["price_index", "balance"], ["c_mktsegment"], steps=20)


# One series: the two lag coefficients in closed form, the steps as a recursion, the clip at the end.
@query(
    "ar_forecast",
    """WITH RECURSIVE s AS (SELECT c_mktsegment AS g, year(o_orderdate) AS y, quarter(o_orderdate) AS q, avg(round(o_totalprice * 100)) AS x FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3),
    n AS (SELECT *, lag(x, 1) OVER (PARTITION BY g ORDER BY y, q) AS a, lag(x, 2) OVER (PARTITION BY g ORDER BY y, q) AS b, row_number() OVER (PARTITION BY g ORDER BY y DESC, q DESC) AS back FROM s),
    c AS (SELECT g, avg(x) AS mx, avg(a) AS ma, avg(b) AS mb, var_pop(a) AS aa, var_pop(b) AS bb, covar_pop(a, b) AS ab, covar_pop(x, a) AS xa, covar_pop(x, b) AS xb FROM n WHERE b IS NOT NULL GROUP BY g),
    w AS (SELECT *, (xa * bb - xb * ab) / (aa * bb - ab * ab) AS wa, (xb * aa - xa * ab) / (aa * bb - ab * ab) AS wb FROM c),
    f AS (SELECT g, 0 AS step, max(x) FILTER (WHERE back = 1) AS x1, max(x) FILTER (WHERE back = 2) AS x2 FROM n GROUP BY g
      UNION ALL SELECT f.g, step + 1, mx - wa * ma - wb * mb + wa * x1 + wb * x2, x1 FROM f JOIN w ON f.g = w.g WHERE step < 20),
    r AS (SELECT g, greatest(min(x), avg(x) - 2 * stddev_samp(x)) AS lo, least(max(x), avg(x) + 2 * stddev_samp(x)) AS hi FROM s GROUP BY g)
    SELECT f.g AS c_mktsegment, CAST(step AS INTEGER) AS step, 'var' AS method, round(least(hi, greatest(lo, x1)), 2) AS price_index FROM f JOIN r ON f.g = r.g WHERE step > 0""",
)
def ar_forecast(spark, sf):
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    q = o.groupBy("c_mktsegment", F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("quarter")).agg(F.avg(cents("o_totalprice")).alias("price_index"))
    return forecast.var_forecast(q, ["price_index"], ["c_mktsegment"]).withColumn("price_index", F.round("price_index", 2))


def _growth_inputs(spark, sf):
    # Every order meets every supplier of its class. Sums and counts per class come first: the means of the
    # pairs follow from them, and the pairs, orders times suppliers in number, are not made.
    o = table(spark, sf, "orders").groupBy(
        (F.col("o_custkey") % 50).alias("class"), F.col("o_orderstatus").alias("property_type"),
        F.make_date(F.year("o_orderdate"), F.quarter("o_orderdate") * 3, F.lit(1)).alias("date"),
    ).agg(F.count("*").alias("orders"), F.count("o_totalprice").alias("prices"), F.sum("o_totalprice").alias("price"))
    s = suppliers(spark, sf).groupBy((F.col("s_suppkey") % 50).alias("class"), F.col("s_name").alias("suburb"))
    s = s.agg(F.count("*").alias("places"), F.count("s_acctbal").alias("balances"), F.sum("s_acctbal").alias("balance"))
    pair_mean = lambda total, a, n, b: F.try_divide(F.sum(F.col(total) * F.col(a)), F.sum(F.col(n) * F.col(b)))
    p = o.join(s, "class").groupBy("suburb", "property_type", "date").agg(
        pair_mean("price", "places", "prices", "places").alias("median_rent"), pair_mean("balance", "orders", "balances", "orders").alias("median_personal_income")
    )
    p = p.withColumns({"year": F.year("date"), "quarter": F.quarter("date"), "cpi": F.year("date") - 1995 + F.quarter("date") / 4})
    p = clean.spatial_unit(p)
    edges = spatial.row_stochastic(spatial.neighbour_weights(_places(spark, sf), k=5))
    return p, edges


@query("spatial_forecast")
def spatial_forecast(spark, sf):
    p, edges = _growth_inputs(spark, sf)
    feats = cut_lineage(rent_growth.featured(p, edges))
    fit, _ = rent_growth.fit_log_model(feats, ["cpi"], split=date(2001, 1, 1))
    economy = forecast.var_forecast(feats, ["cpi"], steps=20)
    return forecast.spatial_forecast(feats, edges, fit.as_dict(), economy, ["cpi"], 20)


FIXED_MODEL = {"const": 0.4, "log_rent_lag_1": 0.5, "log_rent_lag_2": 0.2, "log_rent_lag_3": 0.1, "log_rent_lag_4": 0.05, "log_spatial_lag": 0.1, "median_personal_income": 1e-6, "property_F": 0.02, "property_O": -0.01}

GROWTH_SQL = (
    _edges_sql(5)
    + f""", w AS (SELECT src, dst, w / sum(w) OVER (PARTITION BY src) AS w FROM edges),
    y AS (SELECT l_linestatus AS property_type, s_name AS suburb, CAST(make_date(year(l_shipdate), quarter(l_shipdate) * 3, 1) AS DATE) AS date, avg(round(l_extendedprice * 100)) AS r, avg(s_acctbal) AS income FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2, 3),
    m AS (SELECT suburb, date, avg(r) AS m FROM y GROUP BY 1, 2), g AS (SELECT src, date, sum(w * m) / sum(w) AS lag FROM w JOIN m ON m.suburb = dst GROUP BY 1, 2),
    z AS (SELECT y.*, coalesce(lag, 0) AS lag, row_number() OVER (PARTITION BY y.suburb, property_type ORDER BY y.date DESC) AS i FROM y LEFT JOIN g ON g.src = y.suburb AND g.date = y.date),
    s0 AS (SELECT suburb, property_type, max(ln(r)) FILTER (WHERE i = 1) AS l1, max(ln(r)) FILTER (WHERE i = 2) AS l2, max(ln(r)) FILTER (WHERE i = 3) AS l3, max(ln(r)) FILTER (WHERE i = 4) AS l4, max(lag) FILTER (WHERE i = 1) AS lag, max(income) FILTER (WHERE i = 1) AS income, max(r) FILTER (WHERE i = 1) AS base FROM z GROUP BY 1, 2 HAVING count(*) >= 4)"""
)
for _i in range(1, 21):
    _kind = "CASE property_type WHEN 'F' THEN 0.02 WHEN 'O' THEN -0.01 ELSE 0 END"
    GROWTH_SQL += f""", p{_i} AS MATERIALIZED (SELECT *, 0.4 + {_kind} + 0.5 * l1 + 0.2 * l2 + 0.1 * l3 + 0.05 * l4 + 0.1 * ln(greatest(lag, 1e-10)) + 1e-6 * income AS yhat FROM s{_i - 1}),
    n{_i} AS MATERIALIZED (SELECT suburb, avg(exp(yhat)) AS m FROM p{_i} GROUP BY 1), q{_i} AS (SELECT src, sum(w * m) / sum(w) AS lag FROM w JOIN n{_i} n ON n.suburb = dst GROUP BY 1),
    s{_i} AS MATERIALIZED (SELECT p.suburb, property_type, yhat AS l1, l1 AS l2, l2 AS l3, l3 AS l4, coalesce(q.lag, 0) AS lag, income, base FROM p{_i} p LEFT JOIN q{_i} q ON q.src = p.suburb)"""


@query(
    "rent_growth",
    GROWTH_SQL
    + """ SELECT suburb, property_type, base AS baseline_rent, round(exp(yhat), 4) AS forecast_rent, round((exp(yhat) - base) / base * 100, 6) AS percentage_growth, round((exp(yhat) - base) / base * 100 / 5, 6) AS annualized_growth FROM p20""",
)
def rent_growth_query(spark, sf):
    l = table(spark, sf, "lineitem").join(suppliers(spark, sf), F.col("l_suppkey") == F.col("s_suppkey"))
    p = l.groupBy(
        F.col("s_name").alias("suburb"), F.col("l_linestatus").alias("property_type"),
        F.make_date(F.year("l_shipdate"), F.quarter("l_shipdate") * 3, F.lit(1)).alias("date"),
    ).agg(F.avg(cents("l_extendedprice")).alias("median_rent"), F.avg("s_acctbal").alias("median_personal_income"))
    edges = spatial.row_stochastic(spatial.neighbour_weights(_places(spark, sf), k=5))
    p = joins.spatial_lag(p, edges, "date", "median_rent")
    steps = p.select("date").distinct().orderBy("date").limit(1).select(F.explode(F.sequence(F.lit(1), F.lit(20))).alias("step"))
    f = forecast.spatial_forecast(p, edges, FIXED_MODEL, steps, [], 20)
    out = forecast.rent_growth(f, p, 20, 5.0)
    digits = {"forecast_rent": 4, "percentage_growth": 6, "annualized_growth": 6}
    return out.select("suburb", "property_type", "baseline_rent", *[F.round(c, d).alias(c) for c, d in digits.items()])


# --- streaming -----------------------------------------------------------------------------


def _event_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    return ingest.landed_files(spark, sf, schema, "parquet", "events*.parquet", files_per_batch=1)


def _places_for(spark, label):
    return shared_path(spark, label), shared_path(spark, label + "-checkpoint")


@query("stream_ingest", "SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1")
def stream_ingest(spark, sf):
    out = ingest.ingest(_event_stream(spark, sf), *_places_for(spark, "ingest"))
    return out.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query(
    "stream_latest",
    "SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
)
def stream_latest(spark, sf):
    stream = _event_stream(spark, sf).select("user_id", "event_id", "ts", "event_type", "value")
    out = ingest.latest_per_key(stream, *_places_for(spark, "latest"), ["user_id"], ["ts", "event_id"])
    return out.select("user_id", "event_id", "event_type", "value")


@query(
    "stream_quarterly",
    f"SELECT event_type, {QTR.format(d='ts')}, CAST(make_date(year(ts), quarter(ts) * 3, 1) AS DATE) AS date, avg(round(value * 100)) AS value, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1, 2, 3, 4",
)
def stream_quarterly(spark, sf):
    stream = _event_stream(spark, sf).withColumn("value", cents("value"))
    return ingest.quarterly_means(stream, *_places_for(spark, "quarterly"), "ts", "value", ["event_type"])


@query("stream_dedup", "SELECT count(*) AS n, count(DISTINCT user_id) AS users FROM (SELECT DISTINCT event_id, user_id FROM events)")
def stream_dedup(spark, sf):
    path, checkpoint = _places_for(spark, "dedup")
    twice = _event_stream(spark, sf).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    twice = twice.withColumn("ts", F.col("ts").cast("timestamp"))
    once = ingest.deduplicated(twice, ["event_id"], "ts", "60 days")
    out = ingest.ingest(once, path, checkpoint)
    return out.agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))
