"""Queries for whole workflows, sinks read back, and resumed runs."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from leasegrid.operators import model
from leasegrid.plans import liveability, listings, rent_growth, schools
from leasegrid.queries.registry import CUSTOMERS, SUPPLIERS, WEEKLY, customers, priced_orders, query, suppliers, table
from leasegrid.queries.spatial_and_models import EDIT
from leasegrid.session import shared_path
from leasegrid.sources import files, nested
from leasegrid.streaming import ingest

# --- sources and sinks ----------------------------------------------------------------


@query(
    "keyed_files",
    "SELECT n_nationkey, n_name, count(*) OVER (PARTITION BY n_regionkey) AS rows_of_file, n_regionkey < 2 AS in_first_two FROM nation",
)
def keyed_files(spark, sf):
    """One file per region; the key of a row is its file's stem, and the limit takes the first files by path."""
    path, schema = shared_path(spark, "keyed"), "n_nationkey int, n_name string"
    n = table(spark, sf, "nation").repartition("n_regionkey")
    n.write.partitionBy("n_regionkey").option("header", True).csv(path)
    every = files.read_keyed(spark, f"{path}/*", schema)
    listed = files.available_files(spark, f"{path}/*").withColumn("file_key", files.file_stem(F.col("file_name"))).select("path", "file_key")
    # parts of several folders share a stem, so the listing tells them apart by path
    sizes = every.withColumn("path", F.col("_metadata.file_path")).groupBy("path").agg(F.count("*").alias("rows_of_file"))
    keyed = every.withColumn("path", F.col("_metadata.file_path")).join(sizes, "path").join(listed, ["path", "file_key"], "left_semi")
    first = files.read_keyed(spark, f"{path}/*", schema, limit=2).select(F.col("n_nationkey").alias("k"))
    out = keyed.join(first, F.col("n_nationkey") == F.col("k"), "left")
    return out.select("n_nationkey", "n_name", "rows_of_file", F.col("k").isNotNull().alias("in_first_two"))


@query("mixed_encodings", "SELECT c_custkey, c_name || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE ' École Straße ÿ' END AS name FROM customer")
def mixed_encodings(spark, sf):
    """Some files in UTF-8, some in Latin-1, read in one call."""
    accent = F.when(F.col("c_custkey") % 3 == 0, "").otherwise(" École Straße ÿ")
    c = table(spark, sf, "customer").select("c_custkey", F.concat("c_name", accent).alias("name"))
    path = shared_path(spark, "encodings")
    c.where("c_custkey % 2 = 0").write.option("header", True).csv(f"{path}/utf8", encoding="UTF-8")
    c.where("c_custkey % 2 = 1").write.option("header", True).csv(f"{path}/latin1", encoding="ISO-8859-1")
    return files.read_csv_any_encoding(spark, f"{path}/*", "c_custkey bigint, name string")


@query("drifting_headers", "SELECT 'c' || c_custkey AS id, c_name || ', \"quoted\"' AS \"name, full\", c_mktsegment AS segment, NULL::VARCHAR AS extra FROM customer UNION ALL SELECT 's' || s_suppkey, s_name || ', \"quoted\"', NULL, 'x' || s_nationkey FROM supplier")
def drifting_headers(spark, sf):
    """Two headers in different order, one name with a comma, cells with commas and quotes."""
    path = shared_path(spark, "headers")
    full = lambda c: F.concat(c, F.lit(', "quoted"')).alias("name, full")
    c = table(spark, sf, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("id"), full("c_name"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf, "supplier").select(F.concat(F.lit("x"), "s_nationkey").alias("extra"), full("s_name"), F.concat(F.lit("s"), "s_suppkey").alias("id"))
    for name, df in (("a", c), ("b", s)):
        df.write.option("header", True).option("escape", '"').csv(f"{path}/{name}")
    return files.merge_batches(spark, f"{path}/*")


@query("geojson_stops", f"SELECT 'S' || s_suppkey AS stop_id, s_name AS stop_name, CASE WHEN s_nationkey % 2 = 0 THEN 'TRAM' ELSE 'BUS' END AS mode, round(lat, 6) AS lat, round(lon, 6) AS lon FROM ({SUPPLIERS})")
def geojson_stops(spark, sf):
    """FeatureCollections of at most a hundred points, one file each."""
    s = suppliers(spark, sf)
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.concat(F.lit("S"), "s_suppkey").alias("STOP_ID"), F.col("s_name").alias("STOP_NAME"), F.when(F.col("s_nationkey") % 2 == 0, "TRAM").otherwise("BUS").alias("MODE")).alias("properties"),
        F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates")).alias("geometry"),
    )
    sheets = s.groupBy(F.floor(F.col("s_suppkey") / 100).alias("sheet")).agg(F.collect_list(feature).alias("features"))
    doc = F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features")).alias("value")
    path = shared_path(spark, "geojson")
    sheets.select("sheet", doc).repartition("sheet").write.partitionBy("sheet").text(path)
    out = nested.read_geojson_points(spark, path)
    return out.select(F.col("STOP_ID").alias("stop_id"), F.col("STOP_NAME").alias("stop_name"), F.col("MODE").alias("mode"), F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"))


@query("parquet_sink", "SELECT p_partkey, p_name, p_size, p_brand, 7 AS files_read FROM part")
def parquet_sink(spark, sf):
    """Overwritten, partitioned and sized Parquet, read back; and the number of files of a coalesced write."""
    p, path = table(spark, sf, "part").select("p_partkey", "p_name", "p_size", "p_brand"), shared_path(spark, "sink")
    files.write_parquet(p.limit(1), path)
    files.write_parquet(p, path, partition_by=["p_brand"], max_records=50)
    few = shared_path(spark, "few")
    files.write_parquet(p.repartition(20), few, files=7)
    n = files.available_files(spark, few, "*.parquet").count()
    return spark.read.parquet(path).select("p_partkey", "p_name", "p_size", F.col("p_brand").cast("string").alias("p_brand"), F.lit(n).cast("int").alias("files_read"))


@query("write_if_absent", "SELECT s_suppkey AS key, s_name AS name FROM supplier")
def write_if_absent(spark, sf):
    """The first write stays, the second is ignored."""
    path = shared_path(spark, "absent")
    files.write_if_absent(table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")), path)
    files.write_if_absent(table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name")), path)
    return files.read_csv(spark, path, "key bigint, name string")


@query("json_report", "SELECT c_nationkey, count(*) AS n, round(avg(c_acctbal), 6) AS mean FROM customer GROUP BY 1")
def json_report(spark, sf):
    path = shared_path(spark, "report")
    files.write_report(table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"), F.round(F.avg("c_acctbal"), 6).alias("mean")), path, "json")
    return spark.read.schema("c_nationkey int, n bigint, mean double").json(path)


@query("tolerant_load", "SELECT 'nation' AS dataset, true AS loaded, count(*) AS n FROM nation UNION ALL SELECT 'region', true, count(*) FROM region UNION ALL SELECT 'no such table', false, NULL")
def tolerant_load(spark, sf):
    loaders = {name: (lambda name=name: table(spark, sf, name)) for name in ("nation", "region", "no such table")}
    frames, skipped = files.load_available(loaders)
    out = spark.createDataFrame([(name, False, None) for name in skipped], "dataset string, loaded boolean, n bigint")
    for name, df in frames.items():
        out = out.unionByName(df.agg(F.count("*").alias("n")).select(F.lit(name).alias("dataset"), F.lit(True).alias("loaded"), "n"))
    return out


# --- resumed runs -----------------------------------------------------------------------


@query("stream_resume", "SELECT event_type, count(*) AS n, round(sum(value), 2) AS total, 3 AS runs FROM events GROUP BY 1")
def stream_resume(spark, sf):
    """Two landings and three runs on one checkpoint: every row counts once."""
    e, land = table(spark, sf, "events"), shared_path(spark, "landing")
    path, checkpoint = shared_path(spark, "resumed"), shared_path(spark, "resumed-checkpoint")
    for part in ("event_id % 2 = 0", "event_id % 2 = 1", None):
        if part:
            e.where(part).write.mode("append").parquet(land)
        out = ingest.ingest(ingest.landed_files(spark, land, e.schema, "parquet"), path, checkpoint)
    return out.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"), F.lit(3).alias("runs"))


@query("saved_model", "SELECT count(*) AS n, CAST(0 AS BIGINT) AS differing FROM part")
def saved_model(spark, sf):
    """A fitted pipeline written, read again and applied: same predictions."""
    p = table(spark, sf, "part").select("p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_brand", F.col("p_retailprice").alias("y"))
    stages = [*model.preprocessor(p, ["p_size"], ["p_brand"]), model.boosted_trees("y", maxIter=3, maxDepth=3)]
    fitted, path = Pipeline(stages=stages).fit(model.spread_rows(p)), shared_path(spark, "model")
    model.save_model(fitted, path)
    a = fitted.transform(p).select("p_partkey", F.col("prediction").alias("a"))
    b = model.load_model(path).transform(p).select("p_partkey", F.col("prediction").alias("b"))
    return a.join(b, "p_partkey").agg(F.count("*").alias("n"), F.count_if(F.col("a") != F.col("b")).alias("differing"))


@query(
    "preprocessed",
    """WITH p AS (SELECT p_partkey, CASE WHEN p_size % 4 <> 0 THEN p_size::DOUBLE END AS size, CASE WHEN p_size % 5 <> 0 THEN p_brand END AS brand FROM part),
    f AS (SELECT p_partkey, coalesce(size, (SELECT quantile_cont(size, 0.5) FROM p)) AS size, coalesce(brand, (SELECT arg_min(brand, (-n, brand)) FROM (SELECT brand, count(*) AS n FROM p WHERE brand IS NOT NULL GROUP BY 1))) AS brand FROM p),
    l AS (SELECT list(DISTINCT brand) AS brands FROM f), n AS (SELECT brand, count(*) AS n FROM f GROUP BY 1)
    SELECT p_partkey, size, 1e0 AS hot_of_own_brand, CAST(len(brands) AS INTEGER) AS brands FROM f, l""",
)
def preprocessed(spark, sf):
    """Median and most frequent fill, one-hot of the brand: the vector's parts by name."""
    p = table(spark, sf, "part").select(
        "p_partkey", F.when(F.col("p_size") % 4 != 0, F.col("p_size").cast("double")).alias("size"), F.when(F.col("p_size") % 5 != 0, F.col("p_brand")).alias("brand")
    )
    out = Pipeline(stages=model.preprocessor(p, ["size"], ["brand"])).fit(p).transform(p)
    attrs = out.schema["features"].metadata["ml_attr"]["attrs"]
    place = {a["name"].removeprefix("brand__o_"): a["idx"] for group in attrs.values() for a in group}
    at = F.create_map(*[F.lit(v) for k in place for v in (k, place[k])])
    x = vector_to_array("features")
    return out.select("p_partkey", F.get(x, F.lit(0)).alias("size"), F.get(x, at[F.col("brand__f")]).alias("hot_of_own_brand"), (F.size(x) - 1).alias("brands"))


# --- workflows ---------------------------------------------------------------------------

_MODES = ", ".join(
    f"""{c}_m AS (SELECT property_type, arg_min({c}, (-n, {c})) AS {c}_mode FROM (SELECT property_type, {c}, count(*) AS n FROM big WHERE {c} IS NOT NULL GROUP BY 1, 2) GROUP BY 1),
    {c}_a AS (SELECT arg_min({c}, (-n, {c})) AS {c}_all FROM (SELECT {c}, count(*) AS n FROM big WHERE {c} IS NOT NULL GROUP BY 1))"""
    for c in ("bedrooms", "bathrooms", "car_spaces")
)


@query(
    "workflow_archive",
    f"""WITH rows AS (SELECT o_custkey AS property_id, {WEEKLY} AS rent, CASE WHEN o_orderkey % 997 = 0 THEN 'rare' || o_orderkey WHEN o_custkey % 40 = 1 THEN 's1 north-s1' ELSE 's' || (o_custkey % 40) END AS suburb,
      CASE WHEN o_orderkey % 7 > 0 THEN CAST(o_orderkey % 4 AS INTEGER) END AS bedrooms, CAST(o_orderkey % 3 AS INTEGER) AS bathrooms, CASE WHEN o_orderkey % 5 > 0 THEN CAST(o_orderkey % 2 AS INTEGER) END AS car_spaces,
      o_orderstatus AS property_type, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(quarter(o_orderdate) AS INTEGER) AS quarter, strftime(o_orderdate, '%Y%m%d') || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS stamp FROM orders),
    big AS (SELECT * FROM rows WHERE suburb IN (SELECT suburb FROM rows GROUP BY 1 HAVING count(*) > 10)), {_MODES},
    filled AS (SELECT b.* REPLACE (coalesce(b.bedrooms, bedrooms_mode, bedrooms_all) AS bedrooms, coalesce(b.bathrooms, bathrooms_mode, bathrooms_all) AS bathrooms, coalesce(b.car_spaces, car_spaces_mode, car_spaces_all) AS car_spaces)
      FROM big b LEFT JOIN bedrooms_m USING (property_type) LEFT JOIN bathrooms_m USING (property_type) LEFT JOIN car_spaces_m USING (property_type), bedrooms_a, bathrooms_a, car_spaces_a)
    SELECT property_id, round(rent, 4) AS rental_price, bedrooms, bathrooms, car_spaces, property_type, suburb, year, quarter, '7 Main Street, Nation, VIC 3000' AS address
    FROM filled WHERE rent IS NOT NULL QUALIFY row_number() OVER (PARTITION BY property_id ORDER BY year DESC, quarter DESC, stamp DESC) = 1""",
)
def workflow_archive(spark, sf):
    """Archive rows of every order to the latest complete row per customer."""
    o, k = priced_orders(spark, sf), F.col("o_orderkey")
    suburb = F.when(k % 997 == 0, F.concat(F.lit("RARE"), k)).otherwise(F.concat(F.lit("S"), F.col("o_custkey") % 40))
    rows = o.select(
        F.col("o_custkey").alias("property_id"), F.concat(F.lit("/"), "o_custkey", F.lit("-7-main-street-nation-vic-3000-"), "o_custkey").alias("url"),
        F.col("price_text").alias("rental_price"), F.when(k % 7 > 0, k % 4).alias("bedrooms"), (k % 3).alias("bathrooms"), F.when(k % 5 > 0, k % 2).alias("car_spaces"),
        F.col("o_orderstatus").alias("property_type"), F.lit(0).alias("land_area"), F.lit("").alias("property_features"), suburb.alias("suburb"), F.lit("3000").alias("postcode"),
        F.lit("").alias("scraped_date"), F.lit("").alias("wayback_url"), F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lpad(k.cast("string"), 12, "0")).alias("wayback_time"),
        F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("quarter"),
    )
    aliases = table(spark, sf, "region").where("r_regionkey = 1").select(F.lit("s1").alias("alias"), F.lit("s1 north-s1").alias("canonical"))
    out = listings.clean_archive(rows, aliases)
    return out.withColumn("rental_price", F.round("rental_price", 4))


@query(
    "workflow_schools",
    f"""WITH raw AS (SELECT p_partkey AS no, upper(substr(p_name, 1, 1)) || substr(p_name, 2) || ' Secondary College of ' || p_brand AS u, p_size % 3 AS sector, ['Secondary', 'Primary', 'Language', 'Camp', 'Pri/Sec'][p_size % 5 + 1] AS kind,
      CASE WHEN p_size % 7 = 0 THEN 'C' WHEN p_size % 11 <> 0 THEN 'O' END AS status, 2000 + p_size % 20 AS year, p_partkey % 4 AS x FROM part),
    once AS (SELECT * FROM raw a WHERE NOT EXISTS (SELECT 1 FROM raw b WHERE a.x = b.x AND (b.year, b.no) < (a.year, a.no) AND {EDIT} >= 0.99)),
    open AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY year, no) AS i FROM once WHERE kind NOT IN ('Language', 'Camp') AND status IS DISTINCT FROM 'C'),
    kept AS (SELECT * FROM open WHERE u NOT IN (SELECT u FROM open WHERE i > 1 GROUP BY u, sector, kind, year HAVING count(*) > 1)),
    k AS (SELECT lower(p_name) || ' secondary college of ' || lower(p_brand) AS u, max(1 + p_size) AS v FROM part WHERE p_partkey % 3 = 0 GROUP BY 1),
    a0 AS (SELECT DISTINCT lower(u) AS u FROM kept), m AS (SELECT a.u AS asked, arg_max(b.v, ({EDIT}, b.u)) AS v FROM a0 a JOIN k b ON {EDIT} >= 0.85 GROUP BY 1),
    r AS (SELECT kept.*, coalesce(v, CASE WHEN kind IN ('Secondary', 'Pri/Sec') THEN 101 END) AS rank FROM kept LEFT JOIN m ON asked = lower(kept.u))
    SELECT u AS school_name, year AS establishment_year, kind AS school_type, CAST(x AS INTEGER) AS x, rank AS vic_secondary_rank, round(1 - (ln(rank) / ln(101) + 0.0001e0), 4) AS school_goodness FROM r""",
)
def workflow_schools(spark, sf):
    """Open schools without near-duplicates or repeated names, ranked by fuzzy name."""
    p, size = table(spark, sf, "part"), F.col("p_size")
    name = F.concat(F.upper(F.substring("p_name", 1, 1)), F.expr("substring(p_name, 2)"), F.lit(" Secondary College of "), "p_brand")
    kinds = F.array(*[F.lit(k) for k in ("Secondary", "Primary", "Language", "Camp", "Pri/Sec")])
    raw = p.select(
        name.alias("School_Name"), (size % 3).cast("string").alias("Education_Sector"), F.get(kinds, size % 5).alias("School_Type"),
        F.when(size % 7 == 0, "C").when(size % 11 != 0, "O").alias("School_Status"), (F.lit(2000) + size % 20).alias("establishment_year"),
        (F.lit(140) + F.col("p_partkey") % 4).alias("X"), F.lit(-37.8).alias("Y"), F.col("p_partkey").alias("School_No"),
    )
    ranks = p.where("p_partkey % 3 = 0").select(F.concat(name, F.lit(", main campus")).alias("school_name"), (size + 1).alias("vic_secondary_rank"))
    out = schools.ranked(schools.process_schools(raw), ranks)
    return out.select("school_name", "establishment_year", "school_type", (F.col("lon") - 140).cast("int").alias("x"), "vic_secondary_rank", "school_goodness")


@query(
    "workflow_enrich",
    f"""WITH l AS (SELECT c_custkey AS id, c_nationkey AS suburb, lat, lon FROM ({CUSTOMERS})), p AS (SELECT id, id % 9 AS n, CASE WHEN id % 3 > 0 THEN id * 1.5e0 END AS d FROM l WHERE id % 4 > 0),
    t AS (SELECT l.*, coalesce(p.n, 0) AS count_cafe, p.d, CASE WHEN l.id % 5 > 0 THEN 'POLYGON ' || l.id END AS iso FROM l LEFT JOIN p USING (id)),
    own AS (SELECT a.id, arg_min(b.d, ((a.lat - b.lat) * (a.lat - b.lat) + (a.lon - b.lon) * (a.lon - b.lon), b.id)) AS d FROM t a JOIN t b USING (suburb) WHERE a.d IS NULL AND b.d IS NOT NULL GROUP BY 1),
    far AS (SELECT a.id, arg_min(b.d, ((a.lat - b.lat) * (a.lat - b.lat) + (a.lon - b.lon) * (a.lon - b.lon), b.id)) AS d FROM t a, t b WHERE a.d IS NULL AND b.d IS NOT NULL AND a.id NOT IN (SELECT id FROM own) GROUP BY 1),
    iso AS (SELECT a.id, arg_min(b.iso, ((a.lat - b.lat) * (a.lat - b.lat) + (a.lon - b.lon) * (a.lon - b.lon), b.id)) AS iso FROM t a JOIN t b USING (suburb) WHERE a.iso IS NULL AND b.iso IS NOT NULL GROUP BY 1),
    isofar AS (SELECT a.id, arg_min(b.iso, ((a.lat - b.lat) * (a.lat - b.lat) + (a.lon - b.lon) * (a.lon - b.lon), b.id)) AS iso FROM t a, t b WHERE a.iso IS NULL AND b.iso IS NOT NULL AND a.id NOT IN (SELECT id FROM iso) GROUP BY 1)
    SELECT t.id AS property_id, count_cafe AS count_cafe_imputed, coalesce(t.d, own.d, far.d) AS min_dist_cafe_imputed, coalesce(t.iso, iso.iso, isofar.iso) AS driving_5min_imputed
    FROM t LEFT JOIN own USING (id) LEFT JOIN far USING (id) LEFT JOIN iso ON iso.id = t.id LEFT JOIN isofar ON isofar.id = t.id""",
)
def workflow_enrich(spark, sf):
    """Features attached to every customer, gaps filled from the nearest neighbour of the nation."""
    c = customers(spark, sf).select(F.col("c_custkey").alias("property_id"), F.col("c_nationkey").alias("suburb"), "lat", "lon")
    i = F.col("property_id")
    pois = c.where(i % 4 > 0).select("property_id", (i % 9).alias("count_cafe"), F.when(i % 3 > 0, i * 1.5).alias("min_dist_cafe"))
    routes = c.select("property_id", F.lit(1).alias("stationid"), F.lit(1.0).alias("min_route_dist_m"), F.lit(1.0).alias("min_route_dur_s"))
    iso = c.where(i % 5 > 0).select("property_id", F.concat(F.lit("POLYGON "), i).alias("driving_5min"))
    out = listings.enrich(c, pois, routes, [iso])
    return out.select("property_id", "count_cafe_imputed", "min_dist_cafe_imputed", "driving_5min_imputed")


@query(
    "workflow_liveability",
    """WITH l AS (SELECT DISTINCT lower(n_name) AS suburb FROM nation), m AS (SELECT lower(n_name) AS suburb, 1000 + n_nationkey * 10e0 AS income, 300 + n_nationkey * n_regionkey * 1e0 AS rent FROM nation WHERE n_nationkey <> 3),
    r AS (SELECT suburb, income, rent, rent / income AS ratio FROM l JOIN m USING (suburb)),
    s AS (SELECT suburb, ratio, -ratio AS livability_score FROM r), t AS (SELECT suburb, ratio, livability_score FROM s ORDER BY livability_score DESC, suburb LIMIT 6)
    SELECT array_to_string(list_transform(string_split(replace(suburb, '-', ' '), ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS suburb, round(ratio, 8) AS income_rent_ratio FROM t""",
)
def workflow_liveability(spark, sf):
    """Census income and rent per suburb, their ratio, and the best six under display names."""
    n = table(spark, sf, "nation")
    texts = ("Median total household income ($/weekly)", "Median rent ($/weekly)(a)")
    value = [1000 + F.col("n_nationkey") * 10.0, 300 + F.col("n_nationkey") * F.col("n_regionkey") * 1.0]
    stats = F.explode(F.array(*[F.struct(F.lit(t).alias("Statistic"), v.alias("Value")) for t, v in zip(texts, value)]))
    medians = n.where("n_nationkey <> 3").select(F.col("n_name").alias("Suburb"), stats.alias("s")).select("Suburb", "s.*")
    ratios = liveability.census_ratio(n.select(F.lower("n_name").alias("suburb")), medians)
    best = liveability.top_suburbs(ratios.withColumn("livability_score", -F.col("income_rent_ratio")))
    return best.select("suburb", F.round("income_rent_ratio", 8).alias("income_rent_ratio"))


@query(
    "workflow_panel",
    """WITH r AS (SELECT lower(n_name) AS suburb, o_orderstatus AS property_type, year(o_orderdate) AS y, quarter(o_orderdate) AS q, avg(round(o_totalprice * 100)) AS rent FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3, 4),
    e AS (SELECT DISTINCT y, q, y - 1990 + q / 8e0 AS cpi, CASE WHEN y < 1998 THEN 1e0 + q / 16e0 END AS gsp FROM (SELECT year(o_orderdate) AS y, quarter(o_orderdate) AS q FROM orders)),
    p AS (SELECT r.*, cpi, gsp, 100 + n_nationkey AS population_size, 500e0 + n_nationkey AS income, 30e0 + n_nationkey AS age FROM r JOIN e USING (y, q) JOIN nation ON suburb = lower(n_name) WHERE gsp IS NOT NULL)
    SELECT suburb, property_type, CAST(y AS INTEGER) AS year, CAST(q AS INTEGER) AS quarter, round(rent, 4) AS median_rent, cpi, gsp, CAST(population_size AS DOUBLE) AS population_size, income AS median_personal_income, age AS median_age,
    dense_rank() OVER (ORDER BY y, q) - 1 AS time_index, dense_rank() OVER (ORDER BY suburb || '_' || property_type) - 1 AS spatial_index FROM p""",
)
def workflow_panel(spark, sf):
    """Rents joined with the economy and the census, indexed by quarter and unit."""
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    quarter = [F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("quarter")]
    rents = o.groupBy(F.lower("n_name").alias("suburb"), F.col("o_orderstatus").alias("property_type"), *quarter).agg(F.avg(F.round(F.col("o_totalprice") * 100)).alias("median_rent"))
    times = table(spark, sf, "orders").select(*quarter).distinct().withColumn("date", F.make_date("year", F.col("quarter") * 3, F.lit(1)))
    price = times.select("date", "year", "quarter", (F.col("year") - 1990 + F.col("quarter") / 8).alias("CPI (%/y)"))
    activity = times.where("year < 1998").select("date", "year", "quarter", (1 + F.col("quarter") / 16).alias("GSP quarterly components (%/y)"))
    n = table(spark, sf, "nation")
    people = n.select(F.lit("Total").alias("Age group"), (F.col("n_nationkey") + 100).cast("long").alias("Persons"), F.col("n_name").alias("Suburb"))
    stats = [("Median total personal income ($/weekly)", 500.0), ("Median age of persons", 30.0)]
    cells = F.explode(F.array(*[F.struct(F.lit(t).alias("Statistic"), (F.col("n_nationkey") + v).alias("Value")) for t, v in stats]))
    medians = n.select(F.col("n_name").alias("Suburb"), cells.alias("s")).select("Suburb", "s.*")
    panel = rent_growth.indexed(rent_growth.panel(rents, rent_growth.economic_series([price, activity]), people, medians))
    return panel.select(
        "suburb", "property_type", "year", "quarter", F.round("median_rent", 4).alias("median_rent"), "cpi", "gsp", "population_size", "median_personal_income", "median_age", "time_index", "spatial_index"
    )
