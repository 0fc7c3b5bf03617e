"""Queries for sources, sinks and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from leasegrid import constants as C
from leasegrid.functions import dates, geo, numbers, text
from leasegrid.operators import clean, reshape
from leasegrid.queries.registry import (
    CUSTOMERS,
    SUPPLIERS,
    WEEKLY,
    customers,
    haversine_sql,
    priced_orders,
    query,
    suppliers,
    table,
)
from leasegrid.session import shared_path
from leasegrid.sources import files, nested

SITE = "https://homes.example"


def _title_case_words(sql: str) -> str:
    return f"array_to_string(list_transform(string_split({sql}, ' '), lambda x: upper(x[1]) || lower(x[2:])), ' ')"


# --- text -----------------------------------------------------------------------


@query(
    "rent_parse",
    f"""SELECT o_orderkey, {WEEKLY} AS weekly_rent,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'weekly' WHEN '2' THEN 'monthly' WHEN '3' THEN 'weekly'
      WHEN '4' THEN 'weekly' ELSE 'unknown' END AS frequency FROM orders""",
)
def rent_parse(spark, sf):
    c = F.col("price_text")
    return priced_orders(spark, sf).select(
        "o_orderkey", text.weekly_rent(c).alias("weekly_rent"), text.rent_frequency(c).alias("frequency")
    )


def _feature_texts(spark, sf):
    p = table(spark, sf, "part")
    size, name = F.col("p_size"), F.col("p_type")
    rooms = lambda s: F.when(F.col("p_size") > s, F.lit("−")).otherwise(F.col("p_size").cast("string"))
    area = F.concat(F.format_number(F.round("p_retailprice").cast("int"), 0), F.lit("m²,"))
    card = F.concat(rooms(40), F.lit(", ,"), rooms(30), F.lit(", ,"), rooms(20), F.lit(","))
    return p.select(
        "p_partkey",
        F.when(name == "PROMO", F.concat((size / 4).cast("string"), F.lit("ha,")))
        .when(name == "SMALL", F.concat(card, F.lit(" ,"), area))
        .otherwise(card)
        .alias("features"),
        F.concat_ws(",", rooms(40), rooms(30), F.concat(F.lit(" "), rooms(20))).alias("card"),
    )


@query(
    "feature_parse",
    """SELECT p_partkey,
    CAST(CASE WHEN p_type <> 'PROMO' AND p_size <= 40 THEN p_size END AS INTEGER) AS bedrooms,
    CAST(CASE WHEN p_type <> 'PROMO' AND p_size <= 30 THEN p_size END AS INTEGER) AS bathrooms,
    CAST(CASE WHEN p_type <> 'PROMO' AND p_size <= 20 THEN p_size END AS INTEGER) AS car_spaces,
    CAST(CASE WHEN p_type = 'PROMO' THEN p_size * 2500 WHEN p_type = 'SMALL' THEN round(p_retailprice) END AS INTEGER) AS land_area
    FROM part""",
)
def feature_parse(spark, sf):
    return _feature_texts(spark, sf).select("p_partkey", text.property_features(F.col("features")).alias("f")).select("p_partkey", "f.*")


@query(
    "card_parse",
    """SELECT p_partkey, CASE WHEN p_size > 40 THEN '' ELSE CAST(p_size AS VARCHAR) END AS bedrooms,
    CASE WHEN p_size > 30 THEN '' ELSE CAST(p_size AS VARCHAR) END AS bathrooms,
    CASE WHEN p_size > 20 THEN '' ELSE CAST(p_size AS VARCHAR) END AS car_spaces, '' AS land_area FROM part""",
)
def card_parse(spark, sf):
    return _feature_texts(spark, sf).select("p_partkey", text.card_features(F.col("card")).alias("f")).select("p_partkey", "f.*")


@query(
    "slug_address",
    f"""SELECT c_custkey, CAST(c_nationkey + 1 AS VARCHAR) || ' ' || {_title_case_words("lower(c_mktsegment) || ' street'")}
      || ', Nation' || ', VIC ' || CAST(3000 + c_nationkey AS VARCHAR) AS address,
    CAST(c_custkey AS VARCHAR) || '/' || CAST(c_nationkey + 1 AS VARCHAR) || '-' || lower(c_mktsegment)
      || '-street, Nation, VIC ' || CAST(3000 + c_nationkey AS VARCHAR) AS unit_address,
    CAST(c_nationkey + 1 AS VARCHAR) || ' ' || {_title_case_words("lower(c_mktsegment) || ' street'")} AS street FROM customer""",
)
def slug_address(spark, sf):
    street = F.concat((F.col("c_nationkey") + 1).cast("string"), F.lit("-"), F.lower("c_mktsegment"), F.lit("-street"))
    tail = F.concat(F.lit("-nation-vic-"), (F.col("c_nationkey") + 3000).cast("string"), F.lit("-"), F.col("c_custkey").cast("string"))
    url = F.concat(F.lit("/"), F.col("c_custkey").cast("string"), F.lit("-"), street, tail)
    loose = F.concat(F.lit("Unit 7 level 2 "), F.replace(street, F.lit("-"), F.lit(" ")))
    return table(spark, sf, "customer").select(
        "c_custkey",
        text.slug_address(url).alias("address"),
        text.slug_address_with_unit(url).alias("unit_address"),
        text.clean_street(loose).alias("street"),
    )


@query(
    "name_normalise",
    "SELECT page_id, trim(regexp_replace(lower(url), '[0-9]+', '', 'g')) || ' o''hara - x' AS norm FROM pages",
)
def name_normalise(spark, sf):
    raw = F.concat(F.lit("  "), F.upper(F.regexp_replace("url", "[0-9]+", "")), F.lit("   O’HARA –   x, Campus, East"))
    return table(spark, sf, "pages").select("page_id", text.normalise_name(raw).alias("norm"))


@query(
    "suburb_codes",
    """SELECT n_nationkey, CASE WHEN n_regionkey = 0 THEN 'Unknown' ELSE n_name END AS suburb,
    CASE WHEN n_nationkey = 3 THEN 'west brunswick' ELSE lower(n_name) END AS repaired,
    CAST(n_nationkey AS VARCHAR) AS file_number,
    (n_regionkey <> 4) AS is_summary, 'rent/' || lower(n_name) AS slug FROM nation""",
)
def suburb_codes(spark, sf):
    key = F.col("n_nationkey").cast("string")
    coded = F.when(F.col("n_regionkey") == 0, F.col("n_name")).otherwise(F.concat("n_name", F.lit(" (SAL"), key, F.lit(")")))
    named = F.when(F.col("n_nationkey") == 3, F.lit("Brunswick West")).otherwise(F.col("n_name"))
    ages = F.when(F.col("n_regionkey") == 4, F.lit("55")).otherwise(F.concat(key, F.lit("-9 Years")))
    return table(spark, sf, "nation").select(
        "n_nationkey",
        text.suburb_from_code(coded).alias("suburb"),
        text.repair_suburb(F.concat(named, F.lit(" (Vic.)"))).alias("repaired"),
        text.first_number_or_stem(F.concat(F.lit("missing_"), key, F.lit(".csv"))).alias("file_number"),
        text.is_age_summary(ages).alias("is_summary"),
        text.slug(F.concat(F.lit("rent/"), F.col("n_name"))).alias("slug"),
    )


@query(
    "postcode_pairs",
    """SELECT DISTINCT CAST(3000 + c_nationkey AS VARCHAR) AS postcode, lower(c_mktsegment) AS suburb FROM customer""",
)
def postcode_pairs(spark, sf):
    c = table(spark, sf, "customer")
    line = F.concat(F.lit("<li>postcode: "), (F.col("c_nationkey") + 3000).cast("string"), F.lit(" - Suburb: "), F.lower("c_mktsegment"), F.lit("</li>\n<li>other</li>"))
    pairs = c.select(F.explode(text.postcode_pairs(line)).alias("p"))
    return pairs.select("p.*").distinct()


@query(
    "search_urls",
    "SELECT s_suppkey, 'https://homes.example/rent/supplier#' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') || '-vic-' || CAST(3000 + s_nationkey AS VARCHAR) || '/?ssubs=0&page=1' AS url FROM supplier",
)
def search_urls(spark, sf):
    return table(spark, sf, "supplier").select(
        "s_suppkey", text.rent_search_url(SITE, F.col("s_name"), F.col("s_nationkey") + 3000, 1).alias("url")
    )


@query(
    "tidy_fields",
    """SELECT conv_id, turn, trim(text) AS body, coalesce(nullif(role, 'user'), '') AS speaker,
    trim(role) || ' ' || trim(text) AS joined, (role <> 'user') AS complete FROM conversations""",
)
def tidy_fields(spark, sf):
    c = table(spark, sf, "conversations")
    speaker = text.tidy_text(F.nullif("role", F.lit("user")))
    return c.select(
        "conv_id",
        "turn",
        text.tidy_text(F.concat(F.lit("  "), F.col("text"), F.lit(" "))).alias("body"),
        speaker.alias("speaker"),
        text.join_texts(F.array(F.trim("role"), F.trim("text"))).alias("joined"),
        (speaker != "").alias("complete"),
    )


# --- dates, numbers, geometry ------------------------------------------------------


@query(
    "date_parts",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
    strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS readable,
    CAST(make_date(year(o_orderdate), quarter(o_orderdate) * 3, 1) AS DATE) AS last_month,
    CAST(make_date(year(o_orderdate), quarter(o_orderdate) * 3 - 2, 1) AS DATE) AS first_month,
    CAST(o_orderdate AS DATE) AS parsed FROM orders""",
)
def date_parts(spark, sf):
    d = F.col("o_orderdate")
    y, q = F.year(d), dates.month_name_quarter(F.date_format(d, "MMM"))
    shape = F.when(F.col("o_orderstatus") == "O", F.date_format(d, "dd/MM/yyyy")).otherwise(F.date_format(d, "yyyy-MM-dd HH:mm:ss"))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        y.alias("year"),
        q.alias("quarter"),
        dates.readable_stamp(F.date_format(d, "yyyyMMddHHmmss")).alias("readable"),
        dates.quarter_last_month(y, q).alias("last_month"),
        dates.quarter_first_month(y, dates.quarter_of_month(F.month(d))).alias("first_month"),
        F.to_date(dates.mixed_timestamp(shape)).alias("parsed"),
    )


@query(
    "future_quarters",
    """WITH b AS (SELECT o_orderstatus, date_trunc('quarter', max(o_orderdate)) AS q FROM orders GROUP BY 1)
    SELECT o_orderstatus, CAST(i AS INTEGER) AS step,
    CAST(last_day(q + to_months(CAST(i * 3 + 2 AS INTEGER))) AS DATE) AS quarter_end FROM b, range(1, 21) t(i)""",
)
def future_quarters(spark, sf):
    base = table(spark, sf, "orders").groupBy("o_orderstatus").agg(F.to_date(F.max("o_orderdate")).alias("d"))
    ends = dates.future_quarter_ends(F.col("d"), 20)
    out = base.select("o_orderstatus", F.posexplode(ends).alias("i", "quarter_end"))
    return out.select("o_orderstatus", (F.col("i") + 1).alias("step"), "quarter_end")


@query(
    "number_coercion",
    """SELECT doc_id, CAST(regexp_replace(source, '[a-z]', '', 'g') AS DOUBLE) AS from_text, CAST(NULL AS DOUBLE) AS bad,
    n_chars AS chars, round(ln(n_chars), 6) AS log_chars, round(ln(n_chars + 1), 6) AS log1p_chars,
    greatest(least(n_chars, 5000), 100) AS clipped,
    round(CASE WHEN n_chars > 1000 THEN ln(n_chars + 1e-10) ELSE 0 END, 6) AS log_or_zero FROM documents""",
)
def number_coercion(spark, sf):
    n = F.col("n_chars")
    kept = F.when(n > 1000, n)
    return table(spark, sf, "documents").select(
        "doc_id",
        numbers.to_number(F.regexp_replace("source", "[a-z]", "")).alias("from_text"),
        numbers.to_number(F.concat("source", F.lit("?"))).alias("bad"),
        numbers.to_number(n.cast("string"), "bigint").alias("chars"),
        F.round(F.log(n), 6).alias("log_chars"),
        F.round(F.log1p(n), 6).alias("log1p_chars"),
        numbers.clip(n, 100, 5000).cast("long").alias("clipped"),
        F.round(numbers.log_or_zero(kept), 6).alias("log_or_zero"),
    )


@query(
    "school_goodness",
    """SELECT p_partkey, round(1 - (ln(p_size) / ln(101) + 0.0001), 4) AS goodness,
    round(round(1 - (ln(p_size) / ln(101) + 0.0001), 4) / (1 + 0.2 * p_retailprice / 1000), 6) AS score FROM part""",
)
def school_goodness(spark, sf):
    g = numbers.school_goodness(F.col("p_size"))
    return table(spark, sf, "part").select(
        "p_partkey", g.alias("goodness"), F.round(numbers.distance_decay(g, F.col("p_retailprice") / 1000), 6).alias("score")
    )


@query(
    "wkt_points",
    f"""SELECT c_custkey, lat, lon, (c_mktsegment = 'BUILDING') AS missing FROM ({CUSTOMERS}) c WHERE c_mktsegment <> 'BUILDING'
    UNION ALL SELECT c_custkey, NULL, NULL, true FROM customer WHERE c_mktsegment = 'BUILDING'""",
)
def wkt_points(spark, sf):
    c = customers(spark, sf)
    lat_first = F.col("c_mktsegment") == "MACHINERY"
    swapped = geo.swap_point_text(geo.point_text(F.col("lon"), F.col("lat")))
    wkt = F.when(F.col("c_mktsegment") == "BUILDING", F.lit(" NaN ")).when(lat_first, swapped).otherwise(geo.point_text(F.col("lon"), F.col("lat")))
    p = geo.wkt_point(geo.clean_token(wkt))
    return c.select("c_custkey", p.alias("p")).select("c_custkey", "p.lat", "p.lon", F.col("p").isNull().alias("missing"))


@query(
    "distances",
    f"""SELECT c_custkey, round({haversine_sql('c', 's')}, 6) AS haversine,
    round(sqrt((s.lat - c.lat) * (s.lat - c.lat) + (s.lon - c.lon) * (s.lon - c.lon)), 6) AS planar
    FROM ({CUSTOMERS}) c JOIN ({SUPPLIERS}) s ON s.s_suppkey = c.c_nationkey""",
)
def distances(spark, sf):
    c, s = customers(spark, sf), suppliers(spark, sf).select("s_suppkey", F.col("lat").alias("slat"), F.col("lon").alias("slon"))
    j = c.join(s, c["c_nationkey"] == s["s_suppkey"])
    args = [F.col(x) for x in ("lat", "lon", "slat", "slon")]
    return j.select(
        "c_custkey",
        F.round(geo.distance_km(*args), 6).alias("haversine"),
        F.round(geo.distance_km(*args, method="planar"), 6).alias("planar"),
    )


# The inverse geodesic as a recursion over its longitude difference; twelve rounds settle it to far below a millimetre.
_GEODESIC = f"""WITH RECURSIVE p AS (SELECT c_custkey, atan((1 - f) * tan(radians(c.lat))) AS u1, atan((1 - f) * tan(radians(s.lat))) AS u2, radians(s.lon - c.lon) AS l, f, 6378137e0 AS a
    FROM ({CUSTOMERS}) c JOIN ({SUPPLIERS}) s ON c_nationkey = s_suppkey, (SELECT 1 / 298.257223563e0 AS f)),
it AS (SELECT *, l AS lam, 0 AS i FROM p UNION ALL
    SELECT c_custkey, u1, u2, l, f, a, l + (1 - c) * f * sin_a * (sg + c * sin_s * (cos_2m + c * cos_s * (2 * cos_2m * cos_2m - 1))), i + 1 FROM
    (SELECT *, f / 16 * cos2_a * (4 + f * (4 - 3 * cos2_a)) AS c FROM (SELECT *, coalesce(cos_s - 2 * sin(u1) * sin(u2) / nullif(cos2_a, 0), 0) AS cos_2m FROM
    (SELECT *, 1 - sin_a * sin_a AS cos2_a, atan2(sin_s, cos_s) AS sg FROM (SELECT *, coalesce(cos(u1) * cos(u2) * sin(lam) / nullif(sin_s, 0), 0) AS sin_a FROM (SELECT *,
    sqrt(power(cos(u2) * sin(lam), 2) + power(cos(u1) * sin(u2) - sin(u1) * cos(u2) * cos(lam), 2)) AS sin_s, sin(u1) * sin(u2) + cos(u1) * cos(u2) * cos(lam) AS cos_s FROM it WHERE i < 12))))))
SELECT c_custkey, round((1 - f) * a * big_a * (sg - big_b * sin_s * (cos_2m + big_b / 4 * (cos_s * (2 * cos_2m * cos_2m - 1) - big_b / 6 * cos_2m * (4 * sin_s * sin_s - 3) * (4 * cos_2m * cos_2m - 3)))), 2) AS metres FROM
    (SELECT *, 1 + k / 16384 * (4096 + k * (-768 + k * (320 - 175 * k))) AS big_a, k / 1024 * (256 + k * (-128 + k * (74 - 47 * k))) AS big_b FROM (SELECT *, cos2_a * (1 / ((1 - f) * (1 - f)) - 1) AS k,
    coalesce(cos_s - 2 * sin(u1) * sin(u2) / nullif(cos2_a, 0), 0) AS cos_2m, atan2(sin_s, cos_s) AS sg FROM (SELECT *, 1 - sin_a * sin_a AS cos2_a FROM (SELECT *, coalesce(cos(u1) * cos(u2) * sin(lam) / nullif(sin_s, 0), 0) AS sin_a FROM (SELECT *,
    sqrt(power(cos(u2) * sin(lam), 2) + power(cos(u1) * sin(u2) - sin(u1) * cos(u2) * cos(lam), 2)) AS sin_s, sin(u1) * sin(u2) + cos(u1) * cos(u2) * cos(lam) AS cos_s FROM it WHERE i = 12)))))"""


@query("geodesic_distances", _GEODESIC)
def geodesic_distances(spark, sf):
    c, s = customers(spark, sf), suppliers(spark, sf).select("s_suppkey", F.col("lat").alias("slat"), F.col("lon").alias("slon"))
    j = c.join(s, c["c_nationkey"] == s["s_suppkey"])
    return j.select("c_custkey", F.round(geo.geodesic_m("lat", "lon", "slat", "slon"), 2).alias("metres"))


# --- sources and sinks -----------------------------------------------------------------


@query(
    "csv_scan",
    "SELECT l_returnflag, count(*) AS n, round(sum(l_extendedprice), 2) AS total FROM lineitem GROUP BY 1",
)
def csv_scan(spark, sf):
    path = shared_path(spark, "csv")
    files.write_report(table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_extendedprice"), path)
    back = files.read_csv(spark, path, "l_orderkey bigint, l_returnflag string, l_extendedprice double")
    return back.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("total"))


@query(
    "batch_files",
    """SELECT 'batch_' || lpad(CAST(CAST(ceil(i / 500e0) AS BIGINT) AS VARCHAR), 4, '0') AS batch, count(*) AS n,
    min(p_partkey) AS first_key, max(p_partkey) AS last_key
    FROM (SELECT p_partkey, row_number() OVER (ORDER BY p_retailprice, p_partkey) AS i FROM part) GROUP BY 1""",
)
def batch_files(spark, sf):
    path = shared_path(spark, "batches")
    files.write_batches(table(spark, sf, "part").select("p_partkey", "p_retailprice"), ["p_retailprice", "p_partkey"], 500, path)
    back = files.read_csv(spark, path, "p_partkey bigint, p_retailprice double, batch string")
    return back.groupBy("batch").agg(F.count("*").alias("n"), F.min("p_partkey").alias("first_key"), F.max("p_partkey").alias("last_key"))


@query(
    "merged_batches",
    "SELECT c_mktsegment, count(*) AS n, CAST(count(*) AS BIGINT) AS padded FROM customer GROUP BY 1 UNION ALL SELECT NULL, count(*), CAST(0 AS BIGINT) FROM supplier",
)
def merged_batches(spark, sf):
    path = shared_path(spark, "drift")
    table(spark, sf, "customer").select("c_custkey", "c_mktsegment").write.option("header", True).csv(f"{path}/a")
    table(spark, sf, "supplier").select("s_suppkey", "s_name").write.option("header", True).csv(f"{path}/b")
    both = files.merge_batches(spark, f"{path}/*", "*.csv")
    return both.groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.count("c_custkey").alias("padded"))


@query(
    "file_period",
    """SELECT o_orderkey, 'rental_listings_' || strftime(o_orderdate, '%Y_%m') || '.csv' AS file_name,
    CAST(year(o_orderdate) AS INTEGER) AS year, CAST(CASE WHEN month(o_orderdate) % 3 = 0 THEN month(o_orderdate) // 3 END AS INTEGER) AS quarter,
    'rental_listings_' || strftime(o_orderdate, '%Y_%m') AS stem FROM orders""",
)
def file_period(spark, sf):
    d = F.col("o_orderdate")
    named = table(spark, sf, "orders").select("o_orderkey", files.archive_file_name(F.year(d), F.month(d)).alias("file_name"))
    return files.with_file_period(named, F.col("file_name")).withColumn("stem", files.file_stem(F.col("file_name")))


@query(
    "schema_harmonise",
    """SELECT s_name AS name, CAST(s_nationkey AS VARCHAR) AS area, CAST(NULL AS VARCHAR) AS region, 2024 AS establishment_year FROM supplier
    UNION ALL SELECT c_name, CAST(NULL AS VARCHAR), c_mktsegment, 2025 FROM customer""",
)
def schema_harmonise(spark, sf):
    cols = ["name", "area", "region", "establishment_year"]
    s = table(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.col("s_nationkey").cast("string").alias("AREA_Name"), F.lit(2024).alias("establishment_year"))
    c = table(spark, sf, "customer").select(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("Region_Name"), F.lit(2025).alias("establishment_year"))
    renames = {"AREA_Name": "area", "Region_Name": "region"}
    return clean.union_padded(files.harmonise(s, cols, renames), files.harmonise(c, cols, renames))


def _listing_pages(spark, sf):
    o = table(spark, sf, "orders")
    listing = F.struct(
        F.col("o_orderkey").alias("id"),
        F.struct(
            F.concat(F.lit("/"), F.col("o_orderkey").cast("string")).alias("url"),
            F.format_string("$%.0f pw", F.col("o_totalprice")).alias("price"),
            F.struct(F.lit(3).alias("beds"), F.lit(2).alias("baths"), F.lit("House").alias("propertyTypeFormatted")).alias("features"),
            F.struct(F.when(F.col("o_orderstatus") == "O", F.col("o_orderpriority")).alias("suburb"), F.lit("3000").alias("postcode")).alias("address"),
        ).alias("listingModel"),
    )
    listings = F.create_map(F.col("o_orderkey").cast("string"), listing)
    empty = F.lit('{"props":{"pageProps":{"componentProps":{"listingsMap":{}}},"listingsMap":')
    deep = F.lit('{"props":{"pageProps":{"componentProps":{"listingsMap":')
    body = F.when(
        F.col("o_orderstatus") == "F", F.concat(empty, F.to_json(listings), F.lit("}}"))
    ).otherwise(F.concat(deep, F.to_json(listings), F.lit("}}}}")))
    page = F.concat(F.lit('<html><script id="__NEXT_DATA__" type="application/json">'), body, F.lit("</script></html>"))
    return o.select(page.alias("html"), F.date_format("o_orderdate", "yyyyMMddHHmmss").alias("timestamp"), F.lit("page suburb").alias("suburb"), F.lit("3999").alias("postcode"))


@query(
    "listing_json",
    """SELECT o_orderkey AS property_id, '/' || o_orderkey AS url, CAST(3 AS INTEGER) AS bedrooms, CAST(2 AS INTEGER) AS bathrooms,
    CAST(NULL AS INTEGER) AS car_spaces, 'House' AS property_type, '3, ,2, ,,' AS property_features,
    CASE WHEN o_orderstatus = 'O' THEN o_orderpriority ELSE 'page suburb' END AS suburb, '3000' AS postcode,
    strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS scraped_date,
    'https://web.archive.org/web/' || strftime(o_orderdate, '%Y%m%d%H%M%S') || '/https://homes.example/' || o_orderkey AS wayback_url
    FROM orders""",
)
def listing_json(spark, sf):
    out = nested.listings_from_pages(_listing_pages(spark, sf), site=SITE)
    return out.select(
        "property_id", "url", "bedrooms", "bathrooms", "car_spaces", "property_type", "property_features", "suburb", "postcode", "scraped_date", "wayback_url"
    )


@query(
    "listing_details",
    """SELECT c_custkey AS property_id, c_name AS full_address, c_acctbal AS latitude,
    c_mktsegment || ' ' || c_name AS description, CAST(c_nationkey AS DOUBLE) AS renter_percentage,
    CAST(1 AS INTEGER) AS schools_kept FROM customer""",
)
def listing_details(spark, sf):
    c = table(spark, sf, "customer")
    schools = F.array(
        F.struct(F.col("c_name").alias("name"), F.lit("Gov").alias("type"), F.lit("Primary").alias("educationLevel"), F.lit(1.5).alias("distance")),
        F.struct(F.lit("").alias("name"), F.lit("Gov").alias("type"), F.lit("Primary").alias("educationLevel"), F.lit(2.5).alias("distance")),
    )
    detail = F.struct(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("address"),
        F.struct(F.col("c_acctbal").alias("latitude")).alias("map"),
        F.array("c_mktsegment", "c_name").alias("description"),
        F.struct(F.lit(99).alias("renterPercentage")).alias("suburbInsights"),
        F.struct(F.col("c_nationkey").alias("renter")).alias("neighbourhoodInsights"),
        F.struct(schools.alias("schools")).alias("schoolCatchment"),
    )
    doc = F.to_json(F.struct(F.struct(F.struct(detail.alias("componentProps")).alias("pageProps")).alias("props")))
    page = F.concat(F.lit('<script id="__NEXT_DATA__">'), doc, F.lit("</script>"))
    out = nested.listing_details(c.select(page.alias("html")))
    return out.select(
        "property_id", "full_address", "latitude", "description", "renter_percentage", F.size("schools").alias("schools_kept")
    )


@query(
    "html_table",
    """SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS date_text, round(o_totalprice, 2) AS price,
    CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST(o_custkey AS DOUBLE) END AS rate, 'Price' AS header
    FROM orders WHERE o_orderstatus <> 'F'""",
)
def html_table(spark, sf):
    o = table(spark, sf, "orders")
    rate = F.when(F.col("o_orderstatus") == "O", "").when(F.col("o_orderstatus") == "F", "n/a").otherwise(F.col("o_custkey").cast("string"))
    cell = lambda c: F.concat(F.lit("<td class='x'> "), c, F.lit(" </td>"))
    head = F.lit("<table id='t'><tr><th>Date</th><th>Price</th><th>Rate</th></tr><tr><td></td><td>1</td><td>2</td></tr><tr>")
    html = F.concat(head, cell(F.date_format("o_orderdate", "dd/MM/yyyy")), cell(F.format_string("%.2f", "o_totalprice")), cell(rate), F.lit("</tr></table>"))
    rows = nested.html_table(o.select("o_orderkey", html.alias("html")), [1, 2], keep=["o_orderkey"])
    return rows.select(
        "o_orderkey", "date_text", F.col("values")[0].alias("price"), F.col("values")[1].alias("rate"), F.col("headers")[1].alias("header")
    )


@query(
    "page_titles",
    """SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
    CAST(len(regexp_extract_all(html, '<li[^>]*>')) AS INTEGER) AS items, (html LIKE '%__NEXT_DATA__%') AS has_data FROM pages""",
)
def page_titles(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id",
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
        F.size(F.regexp_extract_all("html", F.lit("<li[^>]*>"), F.lit(0))).alias("items"),
        nested.next_data(F.col("html")).isNotNull().alias("has_data"),
    )


@query(
    "isochrone_json",
    """SELECT s_suppkey AS property_id, 'POLYGON ((0.0 0.0, ' || s_nationkey || '.0 0.0, 0.0 0.0))' AS "5min", '' AS "10min",
    'POLYGON ((1.0 1.0, 2.0 2.0, 1.0 1.0))' AS "15min" FROM supplier""",
)
def isochrone_json(spark, sf):
    s = table(spark, sf, "supplier")
    f = lambda v, ring: F.concat(F.lit(f'{{"properties":{{"value":{v}}},"geometry":{{"coordinates":['), ring, F.lit("]}}"))
    near = F.concat(F.lit("[[0,0],["), F.col("s_nationkey").cast("string"), F.lit(",0],[0,0]]"))
    doc = F.concat(F.lit('{"features":['), f(300.0, near), F.lit(","), f(600.0, F.lit("[]")), F.lit(","), f(900.0, F.lit("[[1,1],[2,2],[1,1]]")), F.lit("]}"))
    responses = s.select(F.col("s_suppkey").alias("batch"), doc.alias("json"))
    listings = s.select(F.col("s_suppkey").alias("batch"), F.lit(0).cast("long").alias("ordinal"), F.col("s_suppkey").alias("property_id"))
    return nested.flatten_isochrones(responses, listings).select("property_id", "5min", "10min", "15min")


@query(
    "poi_json",
    f"""SELECT c_custkey AS property_id, CASE WHEN c_mktsegment = 'BUILDING' THEN 'Unnamed' ELSE c_name END AS name,
    lower(c_mktsegment) AS amenity, round(lat, 6) AS lat, round(lon, 6) AS lon FROM ({CUSTOMERS})""",
)
def poi_json(spark, sf):
    c = customers(spark, sf)
    spot = F.struct("lat", "lon")
    way = F.col("c_mktsegment") == "MACHINERY"
    element = F.struct(
        F.when(~way, F.col("lat")).alias("lat"),
        F.when(~way, F.col("lon")).alias("lon"),
        F.when(way, spot).alias("center"),
        F.struct(F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_name")).alias("name"), F.lower("c_mktsegment").alias("amenity")).alias("tags"),
    )
    doc = F.to_json(F.struct(F.array(element).alias("elements")))
    out = nested.flatten_pois(c.select(F.col("c_custkey").alias("property_id"), doc.alias("json")))
    return out.withColumns({"lat": F.round("lat", 6), "lon": F.round("lon", 6)})


@query(
    "prop_keys",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
)
def prop_keys(spark, sf):
    return table(spark, sf, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query(
    "cell_grid",
    """SELECT CAST(col AS INTEGER) AS col, count(*) AS n FROM (SELECT 0 AS col, n_name AS v FROM nation UNION ALL SELECT 1, CAST(n_regionkey AS VARCHAR) FROM nation) GROUP BY 1""",
)
def cell_grid(spark, sf):
    n = table(spark, sf, "nation")
    grid = nested.cells_from_rows(n, F.lit("f"), F.lit("s"), F.col("n_nationkey"), ["n_name", "n_regionkey"])
    return grid.groupBy("col").agg(F.count("*").alias("n"))


@query(
    "flat_headers",
    """SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN p_name WHEN p_type = 'SMALL' THEN p_name ELSE p_type END AS header FROM part""",
)
def flat_headers(spark, sf):
    top = F.when(F.col("p_type") == "PROMO", "Age group (years)").when(F.col("p_type") == "SMALL", "Unnamed: 3").otherwise(F.col("p_type"))
    return table(spark, sf, "part").select("p_partkey", reshape.flatten_headers(top, F.col("p_name"), "Age group (years)").alias("header"))


@query(
    "type_map",
    f"""SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN 'flat' WHEN 'SMALL' THEN 'house' WHEN 'LARGE' THEN 'house' ELSE 'unknown' END AS kind,
    CASE p_type WHEN 'PROMO' THEN 'unknown' WHEN 'SMALL' THEN 'unknown' WHEN 'LARGE' THEN 'house' ELSE 'unknown' END AS strict_kind,
    CASE p_type WHEN 'PROMO' THEN '{C.COMMON_TYPES[1]}' WHEN 'LARGE' THEN 'villa' ELSE 'other' END AS common FROM part""",
)
def type_map(spark, sf):
    t = F.col("p_type")
    named = F.when(t == "PROMO", "Apartment / Unit / Flat").when(t == "SMALL", "New House & Land").when(t == "LARGE", "Villa").otherwise(t)
    return table(spark, sf, "part").select(
        "p_partkey",
        text.property_category(named).alias("kind"),
        text.property_category(named, strict_keys=True).alias("strict_kind"),
        text.common_type(named).alias("common"),
    )
