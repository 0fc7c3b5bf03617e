"""Queries for filters, imputation, reshaping, joins, aggregates, windows and set operations."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from leasegrid import constants as C
from leasegrid.operators import clean, joins, ordering, panel, profile, reshape, score
from leasegrid.plans import schools
from leasegrid.queries.registry import cents, priced_orders, query, table
from leasegrid.sources import nested

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def _t(name):
    return lambda spark, sf: table(spark, sf, name)


# --- filters ------------------------------------------------------------------------


@query(
    "min_group",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 10)""",
)
def min_group(spark, sf):
    return clean.keep_large_groups(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_custkey", 10)


@query(
    "quantile_clip",
    """WITH q AS (SELECT quantile_cont(o_totalprice, 0.01) lo, quantile_cont(o_totalprice, 0.99) hi FROM orders)
    SELECT o_orderkey, o_totalprice FROM orders, q WHERE o_totalprice BETWEEN lo AND hi""",
)
def quantile_clip(spark, sf):
    return clean.clip_quantiles(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice")


@query(
    "quantile_clip_in_turn",
    """WITH a AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_extendedprice < (SELECT quantile_cont(l_extendedprice, 0.99) FROM lineitem))
    SELECT * FROM a WHERE l_extendedprice > (SELECT quantile_cont(l_extendedprice, 0.01) FROM a)""",
)
def quantile_clip_in_turn(spark, sf):
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice")
    return clean.clip_quantiles_in_turn(l, "l_extendedprice")


@query("fixed_range", "SELECT p_partkey, p_retailprice FROM part WHERE p_retailprice BETWEEN 950 AND 1000")
def fixed_range(spark, sf):
    return clean.filter_target(table(spark, sf, "part").select("p_partkey", "p_retailprice"), "p_retailprice", "fixed", (950, 1000))


@query(
    "allow_deny",
    """SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')
    AND coalesce(nullif(c_mktsegment, 'BUILDING'), '') NOT IN ('MACHINERY')""",
)
def allow_deny(spark, sf):
    c = clean.keep_listed(table(spark, sf, "customer"), "c_mktsegment", ["BUILDING", "MACHINERY", "HOUSEHOLD"])
    c = c.select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"))
    return clean.drop_listed(c, "segment", ["MACHINERY"])


@query(
    "null_filters",
    """SELECT d.doc_id, quality FROM documents d LEFT JOIN labels l USING (doc_id) WHERE quality IS NOT NULL AND nullif(lang, 'en') IS NOT NULL""",
)
def null_filters(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.nullif("lang", F.lit("en")).alias("lang"))
    j = joins.attach_features(d, "doc_id", table(spark, sf, "labels"))
    return clean.drop_nulls(j, ["quality", "lang"]).select("doc_id", "quality")


@query("sparse_columns", "SELECT doc_id, lang FROM documents")
def sparse_columns(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang")
    j = joins.attach_features(d, "doc_id", table(spark, sf, "labels").where(F.col("toxic") == 1))
    return clean.drop_sparse_columns(j)


@query(
    "period_keys",
    """SELECT o_orderkey, quarter(o_orderdate) || '_' || year(o_orderdate) AS quarter_year, year(o_orderdate) || 'Q' || quarter(o_orderdate) AS quarter_id,
    o_orderstatus || '_' || replace(o_orderpriority, ' ', '_') AS spatial_unit FROM orders""",
)
def period_keys(spark, sf):
    o = table(spark, sf, "orders").withColumns({"year": F.year("o_orderdate"), "quarter": F.quarter("o_orderdate")})
    o = clean.spatial_unit(clean.quarter_keys(o), "o_orderstatus", "o_orderpriority")
    return o.select("o_orderkey", "quarter_year", "quarter_id", "spatial_unit")


@query(
    "reliability_weights",
    """SELECT o_orderkey, CASE WHEN year(o_orderdate) BETWEEN 1997 AND 1998 THEN 0.1e0 ELSE 1e0 END AS weights, year(o_orderdate) BETWEEN 1997 AND 1998 AS is_unreliable FROM orders""",
)
def reliability_weights(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    return clean.reliability_weights(o, span=(1997, 1998)).drop("year")


@query(
    "temporal_split",
    """SELECT CASE WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN 'train' ELSE 'test' END AS split, count(*) AS n, avg(round(o_totalprice * 100)) AS mean_price FROM orders GROUP BY 1""",
)
def temporal_split(spark, sf):
    a, b = clean.split_at(table(spark, sf, "orders"), "o_orderdate", date(2000, 1, 1))
    both = a.withColumn("split", F.lit("train")).unionByName(b.withColumn("split", F.lit("test")))
    return both.groupBy("split").agg(F.count("*").alias("n"), F.avg(cents("o_totalprice")).alias("mean_price"))


# --- imputation ---------------------------------------------------------------------

PART_GAPS = "SELECT p_partkey, nullif(p_type, 'PROMO') AS kind, CASE WHEN p_size <= 40 AND p_type <> 'LARGE' THEN p_size END AS size FROM part"


def _part_gaps(spark, sf):
    p = table(spark, sf, "part")
    size = F.when((F.col("p_size") <= 40) & (F.col("p_type") != "LARGE"), F.col("p_size"))
    return p.select("p_partkey", F.nullif("p_type", F.lit("PROMO")).alias("kind"), size.alias("size"))


@query(
    "mode_impute",
    f"""WITH p AS ({PART_GAPS}), n AS (SELECT kind, size, count(*) AS c FROM p WHERE size IS NOT NULL GROUP BY ALL),
    m AS (SELECT kind, size AS mode FROM n QUALIFY row_number() OVER (PARTITION BY kind ORDER BY c DESC, size) = 1),
    o AS (SELECT size AS mode FROM (SELECT size, sum(c) AS c FROM n GROUP BY 1) ORDER BY c DESC, size LIMIT 1)
    SELECT p.p_partkey, p.kind, coalesce(p.size, m.mode, o.mode) AS size FROM p LEFT JOIN m ON p.kind = m.kind CROSS JOIN o""",
)
def mode_impute(spark, sf):
    return clean.impute_mode(_part_gaps(spark, sf), "size", "kind").select("p_partkey", "kind", "size")


@query(
    "overall_mode",
    f"""WITH p AS ({PART_GAPS}) SELECT p_partkey, coalesce(size, (SELECT size FROM p WHERE size IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, size LIMIT 1)) AS size FROM p""",
)
def overall_mode(spark, sf):
    return clean.impute_overall_mode(_part_gaps(spark, sf), "size").select("p_partkey", "size")


@query(
    "coalesce_imputed",
    f"""WITH p AS ({PART_GAPS}) SELECT p_partkey, coalesce(size, 7) AS size, coalesce(size, 0) AS count_size_imputed FROM p""",
)
def coalesce_imputed(spark, sf):
    p = _part_gaps(spark, sf).withColumns({"size_imputed": F.lit(7), "count_size": F.col("size")})
    p = clean.fill_counts(p)
    return p.select("p_partkey", clean.coalesce_imputed(p.columns, "size").alias("size"), "count_size_imputed")


@query(
    "pending_work",
    f"""WITH p AS ({PART_GAPS}) SELECT p_partkey, (kind IS NULL AND size IS NULL) AS all_missing FROM p WHERE kind IS NULL OR size IS NULL""",
)
def pending_work(spark, sf):
    p = _part_gaps(spark, sf)
    whole = clean.pending_rows(p, ["kind", "size"], "all").select("p_partkey", F.lit(True).alias("all_missing"))
    part = clean.pending_rows(p, ["kind", "size"], "any").select("p_partkey")
    return joins.attach_features(part, "p_partkey", whole).withColumn("all_missing", F.coalesce("all_missing", F.lit(False)))


BANDS = """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  CASE WHEN l_quantity > 25 THEN l_quantity END AS best_score_driving_5min, CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS n_schools_driving_5min,
  CASE WHEN l_discount > 0.03 THEN l_discount END AS best_score_driving_10min, CASE WHEN l_discount > 0.03 THEN 2 ELSE 0 END AS n_schools_driving_10min,
  CASE WHEN l_tax > 0.04 THEN l_tax END AS best_score_walking_5min, CASE WHEN l_tax > 0.05 THEN 3 END AS n_schools_walking_5min FROM lineitem"""


def _bands(spark, sf):
    when = lambda c, x, v: F.when(F.col(c) > x, v)
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        when("l_quantity", 25, F.col("l_quantity")).alias("best_score_driving_5min"),
        when("l_quantity", 25, 1).otherwise(0).alias("n_schools_driving_5min"),
        when("l_discount", 0.03, F.col("l_discount")).alias("best_score_driving_10min"),
        when("l_discount", 0.03, 2).otherwise(0).alias("n_schools_driving_10min"),
        when("l_tax", 0.04, F.col("l_tax")).alias("best_score_walking_5min"),
        when("l_tax", 0.05, 3).alias("n_schools_walking_5min"),
    )


@query(
    "fallback_fill",
    f"""WITH b AS ({BANDS}) SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
    coalesce(best_score_driving_5min, best_score_driving_10min) AS best_score_driving_5min,
    CASE WHEN best_score_driving_5min IS NULL AND n_schools_driving_5min = 0 AND best_score_driving_10min IS NOT NULL THEN n_schools_driving_10min ELSE n_schools_driving_5min END AS n_schools_driving_5min,
    coalesce(best_score_driving_10min, best_score_driving_5min) AS best_score_driving_10min,
    CASE WHEN best_score_driving_10min IS NULL AND n_schools_driving_10min = 0 AND best_score_driving_5min IS NOT NULL THEN n_schools_driving_5min ELSE n_schools_driving_10min END AS n_schools_driving_10min,
    coalesce(best_score_walking_5min, best_score_driving_5min, best_score_driving_10min) AS best_score_walking_5min,
    CASE WHEN best_score_walking_5min IS NULL AND coalesce(n_schools_walking_5min, 0) = 0 THEN
      CASE WHEN best_score_driving_5min IS NOT NULL THEN n_schools_driving_5min WHEN best_score_driving_10min IS NOT NULL THEN n_schools_driving_10min ELSE n_schools_walking_5min END
      ELSE n_schools_walking_5min END AS n_schools_walking_5min FROM b""",
)
def fallback_fill(spark, sf):
    return schools.fill_from_fallback(_bands(spark, sf))


@query(
    "final_fills",
    f"""WITH b AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, best_score_walking_5min, best_score_driving_5min AS best_dist_km_driving_5min, n_schools_walking_5min FROM ({BANDS}))
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, coalesce(best_score_walking_5min, 3e-8) AS best_score_walking_5min,
    coalesce(best_dist_km_driving_5min, (SELECT max(best_dist_km_driving_5min) FROM b) + 1) AS best_dist_km_driving_5min,
    coalesce(n_schools_walking_5min, 0) AS n_schools_walking_5min FROM b""",
)
def final_fills(spark, sf):
    b = _bands(spark, sf).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "best_score_walking_5min",
        F.col("best_score_driving_5min").alias("best_dist_km_driving_5min"), "n_schools_walking_5min",
    )
    return schools.finalise(b)


# --- dedup, sampling, order -----------------------------------------------------------


@query(
    "keep_latest",
    "SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1",
)
def keep_latest(spark, sf):
    return clean.keep_latest(table(spark, sf, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"])


@query(
    "keep_earliest",
    "SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1",
)
def keep_earliest(spark, sf):
    return clean.keep_earliest(table(spark, sf, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"])


@query(
    "repeated_names",
    """WITH r AS (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS i FROM part),
    bad AS (SELECT DISTINCT p_name FROM r WHERE i > 1 GROUP BY p_name, p_brand, p_type HAVING count(*) > 1)
    SELECT p_partkey, p_name FROM part WHERE p_name NOT IN (SELECT p_name FROM bad)
    UNION ALL SELECT p_partkey, p_brand || p_name FROM part WHERE p_brand || p_name NOT IN (
      SELECT n FROM (SELECT p_brand || p_name AS n, p_size, row_number() OVER (PARTITION BY p_brand || p_name ORDER BY p_partkey) AS i FROM part) WHERE i > 1 GROUP BY n, p_size HAVING count(*) > 1)""",
)
def repeated_names(spark, sf):
    p = table(spark, sf, "part")
    a = clean.drop_repeated_names(p, "p_name", ["p_brand", "p_type"], ["p_partkey"]).select("p_partkey", "p_name")
    b = p.withColumn("p_name", F.concat("p_brand", "p_name"))
    return a.unionByName(clean.drop_repeated_names(b, "p_name", ["p_size"], ["p_partkey"]).select("p_partkey", "p_name"))


SCORE = "CAST('0x' || substr(md5(CAST({k} AS VARCHAR) || ':42'), 1, 13) AS BIGINT)"


@query(
    "strata_sample",
    f"""SELECT c_custkey, c_mktsegment, c_nationkey FROM customer QUALIFY row_number() OVER (PARTITION BY c_mktsegment, c_nationkey ORDER BY {SCORE.format(k='c_custkey')}, c_custkey)
    <= CASE WHEN count(*) OVER (PARTITION BY c_mktsegment, c_nationkey) > 1 THEN round_even(count(*) OVER (PARTITION BY c_mktsegment, c_nationkey) * 0.5e0, 0) ELSE 1 END""",
)
def strata_sample(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    md5 = F.md5(F.concat(F.col("c_custkey").cast("string"), F.lit(":42")))
    s = F.conv(F.substring(md5, 1, 13), 16, 10).cast("bigint")
    return clean.stratified_sample(c, ["c_mktsegment", "c_nationkey"], "c_custkey", 0.5, score=s, score_bits=52)


@query(
    "bucketed_sample",
    f"""SELECT o_orderkey, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderstatus ORDER BY {SCORE.format(k='o_orderkey')}, o_orderkey)
    <= round_even(count(*) OVER (PARTITION BY o_orderstatus) * 0.3e0, 0)""",
)
def bucketed_sample(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    md5 = F.md5(F.concat(F.col("o_orderkey").cast("string"), F.lit(":42")))
    s = F.conv(F.substring(md5, 1, 13), 16, 10).cast("bigint")
    return clean.stratified_sample(o, ["o_orderstatus"], "o_orderkey", 0.3, score=s, score_bits=52, bucket_rows=100)


@query(
    "hash_split",
    """SELECT o_orderkey, CASE WHEN p < 0.45e0 THEN 'train' WHEN p < 0.45e0 + 0.15e0 THEN 'val' ELSE 'test' END AS split
    FROM (SELECT o_orderkey, CAST('0x' || substr(md5('42:' || o_orderkey), 1, 8) AS BIGINT) / 4294967296e0 AS p FROM orders)""",
)
def hash_split(spark, sf):
    s = clean.hash_split(table(spark, sf, "orders"), "o_orderkey", {"train": 0.45, "val": 0.15, "test": 0.4})
    return s.select("o_orderkey", "split")


@query(
    "largest_smallest",
    """SELECT * FROM (SELECT 'top' AS side, c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 6)
    UNION ALL SELECT * FROM (SELECT 'bottom', c_custkey, c_acctbal FROM customer ORDER BY c_acctbal, c_custkey LIMIT 6)""",
)
def largest_smallest(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    top = clean.ranked_rows(c, 6, "c_acctbal", ["c_custkey"]).withColumn("side", F.lit("top"))
    low = clean.ranked_rows(c, 6, "c_acctbal", ["c_custkey"], largest=False).withColumn("side", F.lit("bottom"))
    return top.unionByName(low)


@query(
    "group_mean_topk",
    "SELECT o_custkey, avg(round(o_totalprice * 100)) AS mean FROM orders GROUP BY 1 ORDER BY 2 DESC, o_custkey LIMIT 10",
)
def group_mean_topk(spark, sf):
    o = table(spark, sf, "orders").withColumn("price", cents("o_totalprice"))
    return clean.group_mean_ranked(o, "o_custkey", "price", 10)


@query(
    "by_magnitude",
    "SELECT c_custkey, c_acctbal - 5000 AS coefficient FROM customer ORDER BY abs(c_acctbal - 5000) DESC, c_custkey LIMIT 12",
)
def by_magnitude(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", (F.col("c_acctbal") - 5000).alias("coefficient"))
    return clean.by_magnitude(c, "coefficient", ["c_custkey"]).limit(12)


@query(
    "rank_by_position",
    "SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) AS rank FROM part",
)
def rank_by_position(spark, sf):
    return reshape.rank_by_position(table(spark, sf, "part").select("p_partkey"), "p_partkey")


@query(
    "dense_ids",
    """SELECT o_orderkey, dense_rank() OVER (ORDER BY o_orderstatus, o_orderpriority) - 1 AS unit_index, dense_rank() OVER (ORDER BY o_custkey) - 1 AS customer_index FROM orders""",
)
def dense_ids(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_custkey")
    o = ordering.dense_ids(o, ["o_orderstatus", "o_orderpriority"], "unit_index")
    return ordering.dense_ids(o, ["o_custkey"], "customer_index").select("o_orderkey", "unit_index", "customer_index")


# --- set operations ---------------------------------------------------------------------


@query(
    "union_common",
    "SELECT c_nationkey AS nationkey, c_acctbal AS acctbal FROM customer UNION ALL SELECT s_nationkey, s_acctbal FROM supplier",
)
def union_common(spark, sf):
    strip = lambda d, p: d.toDF(*[c.removeprefix(p) for c in d.columns])
    c, s = strip(table(spark, sf, "customer"), "c_"), strip(table(spark, sf, "supplier"), "s_")
    return clean.union_common(c.drop("name"), s.drop("name"))


@query(
    "union_padded",
    "SELECT c_custkey AS k, c_mktsegment, CAST(NULL AS DOUBLE) AS s_acctbal FROM customer UNION ALL SELECT s_suppkey, NULL, s_acctbal FROM supplier",
)
def union_padded(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), "c_mktsegment")
    return clean.union_padded(c, table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), "s_acctbal"))


@query(
    "key_sets",
    """SELECT 'both' AS side, k FROM (SELECT c_custkey k FROM customer INTERSECT SELECT o_custkey FROM orders)
    UNION ALL SELECT 'only', k FROM (SELECT c_custkey k FROM customer EXCEPT SELECT o_custkey FROM orders)""",
)
def key_sets(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"))
    both = clean.key_intersection(c, o, "k").withColumn("side", F.lit("both"))
    return both.unionByName(clean.key_difference(c, o, "k").withColumn("side", F.lit("only")))


@query(
    "present_columns",
    "SELECT DISTINCT c_mktsegment AS market_segment, c_nationkey AS nation FROM customer",
)
def present_columns(spark, sf):
    c = clean.rename(table(spark, sf, "customer"), {"c_mktsegment": "Market Segment", "c_nationkey": "Nation", "c_name": "geom_name"})
    c = clean.snake_names(clean.drop_present(c, ["c_acctbal", "absent"], ["geom_"]))
    return clean.select_present(c, ["market_segment", "nation", "absent"]).distinct()


# --- reshaping --------------------------------------------------------------------------


def _quarter_grid(spark, sf):
    """Sheet-shaped cells: segments as sheets, nations as rows, quarters as column pairs."""
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    sheet = F.element_at(F.array(*[F.lit(s) for s in C.RENT_SHEETS[:5]]), F.array_position(F.array(*[F.lit(s) for s in SEGMENTS]), F.col("c_mktsegment")).cast("int"))
    at = (F.year("o_orderdate") - 1995) * 4 + F.quarter("o_orderdate") - 1
    agg = o.groupBy(sheet.alias("sheet"), F.col("c_nationkey").alias("n"), at.alias("q")).agg(F.count("*").alias("c"), F.avg(cents("o_totalprice")).alias("m"))
    cells = agg.select(
        "sheet",
        (F.col("n") + 3).alias("row"),
        F.explode(
            F.array(
                F.struct((F.col("q") * 2 + 2).alias("col"), F.col("c").cast("string").alias("value")),
                F.struct((F.col("q") * 2 + 3).alias("col"), F.when(F.col("c") < 2, "-").otherwise(F.col("m").cast("string")).alias("value")),
            )
        ).alias("x"),
    ).select("sheet", "row", "x.*")
    sheets = agg.select("sheet").distinct()
    month = F.element_at(F.array(*[F.lit(m) for m in ("Mar", "Jun", "Sep", "Dec")]), (F.col("q") % 4 + 1).cast("int"))
    year = (F.floor(F.col("q") / 4) + 1995).cast("string")
    heads = agg.select("sheet", "q").distinct().select("sheet", F.lit(1).alias("row"), (F.col("q") * 2 + 2).alias("col"), F.concat_ws(" ", month, year).alias("value"))
    n = table(spark, sf, "nation")
    label = F.when(F.col("n_nationkey") == 7, F.lit("Group Total")).otherwise(F.col("n_name"))
    every = F.explode(F.array(*[F.lit(s) for s in C.RENT_SHEETS[:5]])).alias("sheet")
    names = n.select(every, (F.col("n_nationkey") + 3).alias("row"), F.lit(1).alias("col"), label.alias("value"))
    groups = sheets.select("sheet", F.lit(3).alias("row"), F.lit(0).alias("col"), F.lit("Region").alias("value"))
    title = sheets.select("sheet", F.lit(0).alias("row"), F.lit(0).alias("col"), F.lit("Moving annual median rent by suburb").alias("value"))
    grid = cells.unionByName(heads).unionByName(names).unionByName(groups).unionByName(title)
    return grid.withColumn("file", F.lit("moving.xlsx")).withColumns({"row": F.col("row").cast("int"), "col": F.col("col").cast("int")})


SHEET_CASE = "CASE c_mktsegment " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in zip(SEGMENTS, C.RENT_SHEETS)) + " END"


@query(
    "rent_sheet_long",
    f"""SELECT lower(n_name) AS suburb, {SHEET_CASE} AS property_type, CAST(quarter(o_orderdate) AS INTEGER) AS quarter, CAST(year(o_orderdate) AS INTEGER) AS year,
    avg(round(o_totalprice * 100)) AS median_rent FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    WHERE n_nationkey <> 7 GROUP BY 1, 2, 3, 4 HAVING count(*) >= 2""",
)
def rent_sheet_long(spark, sf):
    return reshape.rent_series(_quarter_grid(spark, sf))


@query(
    "block_melt",
    """SELECT lower(c_mktsegment) AS suburb, 'stat ' || c_nationkey AS statistic, avg(round(c_acctbal * 100)) AS value FROM customer GROUP BY ALL""",
)
def block_melt(spark, sf):
    a = table(spark, sf, "customer").groupBy("c_mktsegment", "c_nationkey").agg(F.avg(cents("c_acctbal")).alias("v"))
    base = F.when(F.col("c_nationkey") < 12, 0).otherwise(3)
    row = F.col("c_nationkey") % 12
    label = F.concat(F.lit("stat "), F.col("c_nationkey").cast("string"))
    cells = F.array(F.struct(base.alias("col"), label.alias("value")), F.struct((base + 1).alias("col"), F.col("v").cast("string").alias("value")))
    grid = a.select(F.lower("c_mktsegment").alias("file"), F.lit("G02").alias("sheet"), (row + F.when(F.col("c_nationkey") == 24, 12).otherwise(0)).alias("row"), F.explode(cells).alias("x"))
    grid = grid.select("file", "sheet", "row", "x.*")
    out = reshape.stack_blocks(grid, [[0, 1], [3, 4]], ["statistic", "value"])
    return out.select(F.col("file").alias("suburb"), "statistic", F.col("value").cast("double").alias("value"))


@query(
    "header_slice",
    """SELECT lower(c_mktsegment) AS suburb, CAST(c_nationkey AS VARCHAR) AS label, count(*) AS n, CAST(sum(CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END) AS BIGINT) AS positive
    FROM (SELECT *, dense_rank() OVER (PARTITION BY c_mktsegment ORDER BY c_nationkey) - 1 AS position FROM customer) WHERE position NOT IN (4, 8) GROUP BY ALL""",
)
def header_slice(spark, sf):
    a = table(spark, sf, "customer").groupBy(F.lower("c_mktsegment").alias("file"), F.col("c_nationkey").alias("k")).agg(F.count("*").alias("n"), F.count_if(F.col("c_acctbal") > 0).alias("p"))
    row = F.col("k") + 7
    cell = lambda i, v: F.struct(F.lit(i).alias("col"), v.cast("string").alias("value"))
    body = a.select("file", row.alias("row"), F.explode(F.array(cell(0, F.col("k")), cell(1, F.col("n")), cell(2, F.col("p")))).alias("x")).select("file", "row", "x.*")
    fixed = F.array(
        *[F.struct(F.lit(r).alias("row"), F.lit(c).alias("col"), F.lit(v).alias("value")) for r, c, v in ((0, 0, "Title"), (5, 1, "PERSONS"), (6, 0, "skipped"), (33, 0, "This table is based on residence"))]
    )
    marks = a.select("file").distinct().select("file", F.explode(fixed).alias("x")).select("file", "x.*")
    grid = body.unionByName(marks).withColumn("sheet", F.lit("G49"))
    out = reshape.slice_between(grid, (1, "PERSONS"), (0, "This table"), ["label", "n", "positive"], drop_positions=[4, 8])
    return out.select(F.col("file").alias("suburb"), "label", F.col("n").cast("bigint").alias("n"), F.col("positive").cast("bigint").alias("positive"))


@query(
    "section_fill",
    """SELECT r_name AS file, CASE WHEN n_nationkey % 7 = 3 THEN 'Total private dwellings'
      WHEN max(CASE WHEN n_nationkey % 7 = 3 THEN n_nationkey END) OVER w > coalesce(max(CASE WHEN n_nationkey % 3 = 0 AND n_nationkey % 7 <> 3 THEN n_nationkey END) OVER w, -1) THEN n_name
      WHEN max(CASE WHEN n_nationkey % 3 = 0 AND n_nationkey % 7 <> 3 THEN n_nationkey END) OVER w IS NULL THEN n_name
      ELSE 'S' || max(CASE WHEN n_nationkey % 3 = 0 AND n_nationkey % 7 <> 3 THEN n_nationkey END) OVER w || ' - ' || n_name END AS label
    FROM nation JOIN region ON n_regionkey = r_regionkey
    WINDOW w AS (PARTITION BY r_name ORDER BY n_nationkey)
    QUALIFY n_nationkey % 3 <> 0 OR n_nationkey % 7 = 3""",
)
def section_fill(spark, sf):
    n = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    k = F.col("n_nationkey")
    label = F.when(k % 7 == 3, F.lit("Total private dwellings")).when(k % 3 == 0, F.concat(F.lit("S"), k.cast("string"), F.lit(":"))).otherwise(F.col("n_name"))
    rows = n.select(F.col("r_name").alias("file"), F.lit("G36").alias("sheet"), k.alias("row"), label.alias("label"))
    return reshape.section_labels(rows, "label").select("file", "label")


QUARTERS = [f"{y}Q{q}" for y in range(1995, 2002) for q in range(1, 5)]


@query(
    "pivot_first",
    "SELECT user_id, "
    + ", ".join(f"arg_min(value, event_id) FILTER (WHERE event_type = '{e}') AS \"{e}\"" for e in EVENT_TYPES)
    + " FROM events GROUP BY 1",
)
def pivot_first(spark, sf):
    return reshape.pivot_first(table(spark, sf, "events"), ["user_id"], "event_type", "value", EVENT_TYPES, "event_id")


@query(
    "melt_quarters",
    "SELECT user_id, event_type AS kind, arg_min(value, event_id) AS value FROM events GROUP BY ALL",
)
def melt_quarters(spark, sf):
    wide = reshape.pivot_first(table(spark, sf, "events"), ["user_id"], "event_type", "value", EVENT_TYPES, "event_id")
    return reshape.melt_quarters(wide, ["user_id"], "kind", "value")


@query(
    "pivot_top_mean",
    "WITH t AS (SELECT user_id FROM events GROUP BY 1 ORDER BY avg(round(value * 100)) DESC, user_id LIMIT 10) SELECT user_id, "
    + ", ".join(f"avg(round(value * 100)) FILTER (WHERE event_type = '{e}') AS \"{e}\"" for e in EVENT_TYPES)
    + " FROM events WHERE user_id IN (SELECT user_id FROM t) GROUP BY 1",
)
def pivot_top_mean(spark, sf):
    e = table(spark, sf, "events").withColumn("value", cents("value"))
    return reshape.pivot_mean_top(e, "user_id", "event_type", "value", EVENT_TYPES, 10)


@query(
    "one_hot",
    "SELECT event_id, " + ", ".join(f"CAST(event_type = '{e}' AS INTEGER)::DOUBLE AS kind_{e}" for e in EVENT_TYPES[1:]) + " FROM events",
)
def one_hot(spark, sf):
    e = table(spark, sf, "events").select("event_id", "event_type")
    levels = reshape.levels_of(e, "event_type")
    return reshape.one_hot(e, "event_type", levels, "kind", drop_first=True).drop("event_type")


TARGETS = {f"{y}_Q{m // 3}": date(y, m, 15) for y in range(1995, 2002) for m in (3, 6, 9, 12)}


@query(
    "nearest_snapshot",
    """WITH t AS (SELECT y || '_Q' || q AS period, make_date(y, q * 3, 15) AS day FROM range(1995, 2002) a(y), range(1, 5) b(q)),
    d AS (SELECT o_custkey, period, o_orderkey, abs(date_diff('day', day, CAST(o_orderdate AS DATE))) AS gap FROM orders, t)
    SELECT o_custkey, period, o_orderkey FROM d WHERE gap <= 45 QUALIFY row_number() OVER (PARTITION BY o_custkey, period ORDER BY gap, o_orderkey) = 1""",
)
def nearest_snapshot(spark, sf):
    return reshape.nearest_snapshots(table(spark, sf, "orders"), ["o_custkey"], F.col("o_orderdate"), "o_orderkey", TARGETS)


@query(
    "quarterly_snapshots",
    """WITH s AS (SELECT DISTINCT c_nationkey AS suburb, c_mktsegment AS postcode, strftime(o_orderdate + to_years(26), '%Y%m%d%H%M%S') AS ts, CAST(o_orderdate + to_years(26) AS DATE) AS d
      FROM orders JOIN customer ON o_custkey = c_custkey),
    t AS (SELECT y || '_Q' || q AS period, make_date(y, q * 3, 15) AS day FROM range(2022, 2026) a(y), range(1, 5) b(q)),
    p AS (SELECT suburb, postcode, period, arg_min(ts, (abs(date_diff('day', day, d)), ts)) AS ts FROM s, t WHERE abs(date_diff('day', day, d)) <= 45 GROUP BY ALL)
    SELECT suburb, postcode, """
    + ", ".join(f"max(ts) FILTER (WHERE period = '{p}') AS \"{p}\"" for p in reshape.quarter_targets())
    + " FROM (SELECT DISTINCT suburb, postcode FROM s) LEFT JOIN p USING (suburb, postcode) GROUP BY 1, 2",
)
def quarterly_snapshots(spark, sf):
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    stamp = F.date_format(F.add_months(F.to_date("o_orderdate"), 26 * 12), "yyyyMMdd'000000'")
    return reshape.quarterly_snapshots(o.select(F.col("c_nationkey").alias("suburb"), F.col("c_mktsegment").alias("postcode"), stamp.alias("timestamp")))


@query(
    "first_per_month",
    """SELECT o_custkey, strftime(o_orderdate, '%Y%m') AS year_month, o_orderkey FROM orders WHERE month(o_orderdate) IN (3, 6, 9, 12)
    QUALIFY row_number() OVER (PARTITION BY o_custkey, strftime(o_orderdate, '%Y%m') ORDER BY o_orderdate, o_orderkey) = 1""",
)
def first_per_month(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    out = reshape.first_per_month(o, ["o_custkey"], "o_orderdate", [3, 6, 9, 12], ["o_orderkey"])
    return out.select("o_custkey", "year_month", "o_orderkey")


# --- joins --------------------------------------------------------------------------------


@query(
    "attach_features",
    """SELECT d.doc_id, quality, toxic, n FROM documents d LEFT JOIN labels l USING (doc_id) LEFT JOIN (SELECT conv_id AS doc_id, count(*) AS n FROM conversations GROUP BY 1) c USING (doc_id)""",
)
def attach_features(spark, sf):
    c = table(spark, sf, "conversations").groupBy(F.col("conv_id").alias("doc_id")).agg(F.count("*").alias("n"))
    return joins.attach_features(table(spark, sf, "documents").select("doc_id"), "doc_id", table(spark, sf, "labels"), c)


QTR = "CAST(year({d}) AS INTEGER) AS year, CAST(quarter({d}) AS INTEGER) AS quarter"


@query(
    "outer_chain",
    f"""WITH a AS (SELECT {QTR.format(d='o_orderdate')}, count(*) AS orders_n FROM orders GROUP BY 1, 2), b AS (SELECT {QTR.format(d='l_shipdate')}, count(*) AS lines_n FROM lineitem GROUP BY 1, 2),
    e AS (SELECT {QTR.format(d='ts')}, count(*) AS events_n FROM events GROUP BY 1, 2)
    SELECT year, quarter, orders_n, lines_n, events_n FROM a FULL JOIN b USING (year, quarter) FULL JOIN e USING (year, quarter)""",
)
def outer_chain(spark, sf):
    def part(name, d, n):
        return table(spark, sf, name).groupBy(F.year(d).alias("year"), F.quarter(d).alias("quarter")).agg(F.count("*").alias(n))

    return joins.outer_chain(["year", "quarter"], part("orders", "o_orderdate", "orders_n"), part("lineitem", "l_shipdate", "lines_n"), part("events", "ts", "events_n"))


@query(
    "geocoded_join",
    """SELECT o_orderkey AS property_id, o_orderpriority AS address, c_acctbal AS lat FROM orders JOIN customer ON o_orderkey = c_custkey WHERE c_acctbal > 0""",
)
def geocoded_join(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("property_id"), F.col("o_orderpriority").alias("address"))
    g = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("property_id"), F.col("c_name").alias("address"), F.col("c_acctbal").alias("lat"), (F.col("c_acctbal") > 0).alias("geocode_success")
    )
    return joins.geocoded(o, g)


@query(
    "semi_keys",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')",
)
def semi_keys(spark, sf):
    keys = table(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("o_custkey"))
    return joins.semi(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), keys, "o_custkey")


@query(
    "alias_map",
    """SELECT c_custkey, CASE WHEN n_regionkey IN (1, 3) THEN lower(r_name) ELSE lower(n_name) END AS suburb FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def alias_map(spark, sf):
    n = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    mapping = n.where(F.col("n_regionkey").isin(1, 3)).groupBy(F.lower("r_name").alias("canonical")).agg(F.collect_list(F.lower("n_name")).alias("aliases"))
    c = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return joins.map_aliases(c.select("c_custkey", F.col("n_name").alias("suburb")), "suburb", joins.alias_table(mapping))


def _combo_panel(spark, sf):
    """Nations, plus hyphenated pairs of neighbouring keys."""
    n = table(spark, sf, "nation").select(F.lower("n_name").alias("a"), "n_nationkey")
    nxt = n.select(F.col("a").alias("b"), (F.col("n_nationkey") - 1).alias("n_nationkey"))
    pairs = n.join(nxt, "n_nationkey").select(F.concat_ws("-", "a", "b").alias("suburb"))
    odd = n.select(F.concat(F.col("a"), F.lit("-nowhere")).alias("suburb"))
    return n.select(F.col("a").alias("suburb")).unionByName(pairs).unionByName(odd)


COMBO = """WITH n AS (SELECT lower(n_name) AS a, n_nationkey AS k FROM nation),
  panel AS (SELECT a AS suburb FROM n UNION ALL SELECT x.a || '-' || y.a FROM n x JOIN n y ON y.k = x.k + 1 UNION ALL SELECT a || '-nowhere' FROM n)"""


@query(
    "combo_aliases",
    COMBO + " SELECT suburb AS canonical, string_split(suburb, '-') AS aliases FROM panel WHERE suburb NOT IN (SELECT a FROM n)",
)
def combo_aliases(spark, sf):
    places = table(spark, sf, "nation").select(F.upper("n_name").alias("locality"))
    return joins.combo_aliases(_combo_panel(spark, sf), places)


@query(
    "combo_avg_join",
    COMBO
    + """, v AS (SELECT lower(n_name) AS s, round(s_acctbal * 100) AS v FROM supplier JOIN nation ON s_nationkey = n_nationkey),
    parts AS (SELECT DISTINCT suburb, unnest(string_split(suburb, '-')) AS s FROM panel WHERE suburb LIKE '%-%'),
    whole AS (SELECT suburb FROM parts LEFT JOIN (SELECT DISTINCT s AS f FROM v) ON s = f GROUP BY 1 HAVING count(f) = count(*)),
    m AS (SELECT suburb, avg(v) AS v FROM parts JOIN whole USING (suburb) JOIN v USING (s) GROUP BY 1)
    SELECT suburb, x.v AS balance FROM panel JOIN (SELECT s AS suburb, v FROM v UNION ALL SELECT suburb, v FROM m) x USING (suburb)""",
)
def combo_avg_join(spark, sf):
    s = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    data = s.select(F.concat("n_name", F.lit(" (Vic.)")).alias("suburb"), cents("s_acctbal").alias("balance"))
    return joins.merge_on_combo(_combo_panel(spark, sf), data, "balance")


@query(
    "postcode_lookup",
    "SELECT 'suburb' AS kind, lower(c_mktsegment) AS found FROM customer WHERE c_nationkey = 7 UNION ALL SELECT 'postcode', CAST(c_nationkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'BUILDING'",
)
def postcode_lookup(spark, sf):
    c = table(spark, sf, "customer").select(F.lower("c_mktsegment").alias("suburb"), F.col("c_nationkey").alias("postcode"))
    a = joins.suburbs_of_postcode(c, "7").select(F.lit("suburb").alias("kind"), F.col("suburb").alias("found"))
    return a.unionByName(joins.postcodes_of_suburb(c, "Building").select(F.lit("postcode").alias("kind"), F.col("postcode").cast("string").alias("found")))


@query("bind_columns", "SELECT conv_id, turn, role, length(text) AS chars FROM conversations")
def bind_columns(spark, sf):
    c = table(spark, sf, "conversations")
    return joins.bind_columns(c.select("conv_id", "turn", "role"), c.select("conv_id", "turn", F.length("text").cast("bigint").alias("chars")), ["conv_id", "turn"])


@query(
    "global_values",
    "SELECT s_suppkey, min(s_acctbal) OVER () AS low, max(s_acctbal) OVER () AS high, max(s_acctbal) OVER () + 1 AS fill FROM supplier",
)
def global_values(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", "s_acctbal")
    return joins.with_global(s, {"low": F.min("s_acctbal"), "high": F.max("s_acctbal"), "fill": F.max("s_acctbal") + 1}).drop("s_acctbal")


# --- aggregates -------------------------------------------------------------------------


@query(
    "quarterly_rollup",
    f"""SELECT CAST(make_date(year(o_orderdate), quarter(o_orderdate) * 3, 1) AS DATE) AS date, {QTR.format(d='o_orderdate')}, avg(round(o_totalprice * 100)) AS mean_price,
    arg_min(round(o_totalprice * 100), (o_orderdate, o_orderkey)) AS first_price, arg_max(round(o_totalprice * 100), (o_orderdate, o_orderkey)) AS last_price FROM orders GROUP BY 1, 2, 3""",
)
def quarterly_rollup(spark, sf):
    o = table(spark, sf, "orders").withColumn("o_totalprice", cents("o_totalprice"))
    part = lambda m: panel.quarterly_rollup(o, "o_orderdate", ["o_totalprice"], m, tie=["o_orderkey"]).withColumnRenamed("o_totalprice", f"{m}_price")
    out = part("mean")
    for m in ("first", "last"):
        out = out.join(part(m), ["date", "year", "quarter"])
    return out


@query(
    "first_per_period",
    f"""SELECT {QTR.format(d='o_orderdate')}, arg_min(o_totalprice, o_orderkey) FILTER (WHERE o_totalprice > 300000) AS price, arg_min(o_orderstatus, o_orderkey) AS status FROM orders GROUP BY 1, 2""",
)
def first_per_period(spark, sf):
    o = table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("quarter"), F.when(F.col("o_totalprice") > 300000, F.col("o_totalprice")).alias("price"), F.col("o_orderstatus").alias("status"), "o_orderkey"
    )
    return panel.first_per_period(o, ["year", "quarter"], ["price", "status"], "o_orderkey")


@query(
    "value_counts",
    "SELECT lang, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM documents GROUP BY 1",
)
def value_counts(spark, sf):
    return profile.value_counts(table(spark, sf, "documents"), "lang", share="share").withColumn("share", F.round("share", 6))


@query(
    "distinct_counts",
    "SELECT count(DISTINCT l_orderkey) AS l_orderkey, count(DISTINCT l_partkey) AS l_partkey, count(DISTINCT l_returnflag) AS l_returnflag FROM lineitem",
)
def distinct_counts(spark, sf):
    return profile.distinct_counts(table(spark, sf, "lineitem"), ["l_orderkey", "l_partkey", "l_returnflag"])


@query(
    "null_profile",
    """WITH j AS (SELECT d.doc_id, lang, quality, toxic FROM documents d LEFT JOIN labels USING (doc_id))
    SELECT c AS column_name, count(*) - count(v) AS nulls, round((count(*) - count(v)) / count(*), 6) AS null_share FROM
    (SELECT unnest(['doc_id', 'lang', 'quality', 'toxic']) AS c, unnest([CAST(doc_id AS VARCHAR), lang, CAST(quality AS VARCHAR), CAST(toxic AS VARCHAR)]) AS v FROM j) GROUP BY 1""",
)
def null_profile(spark, sf):
    d = joins.attach_features(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", table(spark, sf, "labels"))
    return profile.null_profile(d).withColumn("null_share", F.round("null_share", 6))


@query(
    "quality_counts",
    "SELECT count(*) FILTER (WHERE c_acctbal < 0) AS negative, count(*) FILTER (WHERE c_acctbal = 0) AS zero, count(*) FILTER (WHERE c_acctbal > 5000) AS above_ceiling FROM customer",
)
def quality_counts(spark, sf):
    return profile.quality_counts(table(spark, sf, "customer"), "c_acctbal")


DESCRIBE = "count({v}) AS count, round(avg({v}), 4) AS mean, round(stddev_samp({v}), 4) AS std, min({v}) AS min, max({v}) AS max, round(quantile_cont({v}, 0.25), 6) AS q25, round(quantile_cont({v}, 0.5), 6) AS median, round(quantile_cont({v}, 0.75), 6) AS q75"


@query(
    "describe",
    f"SELECT l_returnflag, {DESCRIBE.format(v='l_extendedprice')} FROM lineitem GROUP BY 1 UNION ALL SELECT 'all', {DESCRIBE.format(v='l_extendedprice')} FROM lineitem",
)
def describe(spark, sf):
    l = table(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice")
    out = profile.describe(l, "l_extendedprice", ["l_returnflag"])
    out = out.unionByName(profile.describe(l, "l_extendedprice").withColumn("l_returnflag", F.lit("all")))
    digits = {"mean": 4, "std": 4, "q25": 6, "median": 6, "q75": 6}
    return out.withColumns({c: F.round(c, d) for c, d in digits.items()})


@query(
    "residual_summary",
    """SELECT l_linestatus AS split, round(avg(r), 4) AS mean, round(stddev_samp(r), 4) AS std, round(avg(abs(r)), 4) AS mean_abs, round(quantile_cont(r, 0.5), 6) AS median
    FROM (SELECT l_linestatus, l_extendedprice - l_quantity * 2000 AS r FROM lineitem) GROUP BY 1""",
)
def residual_summary(spark, sf):
    l = table(spark, sf, "lineitem").select(F.col("l_linestatus").alias("split"), F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 2000).alias("p"))
    out = profile.residual_summary(l, "y", "p")
    return out.withColumns({c: F.round(c, 6 if c == "median" else 4) for c in ("mean", "std", "mean_abs", "median")})


@query(
    "snapshot_totals",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, o_custkey, count(*) AS snapshots FROM orders
    GROUP BY GROUPING SETS ((year(o_orderdate)), (month(o_orderdate)), (o_custkey), ())""",
)
def snapshot_totals(spark, sf):
    return profile.snapshot_totals(table(spark, sf, "orders"), "o_custkey", "o_orderdate")


@query("mean_per_key", "SELECT count(o_custkey) / count(DISTINCT o_custkey) AS mean_per_key FROM orders")
def mean_per_key(spark, sf):
    return profile.mean_per_key(table(spark, sf, "orders"), "o_custkey")


@query("success_rate", "SELECT round(avg(CAST(toxic = 1 AS INTEGER)), 8) AS success_rate FROM labels")
def success_rate(spark, sf):
    l = table(spark, sf, "labels").withColumn("hit", F.col("toxic") == 1)
    return profile.success_rate(l, "hit").withColumn("success_rate", F.round("success_rate", 8))


@query(
    "threshold_counts",
    """SELECT count(*) AS total, count(*) FILTER (WHERE value > 0) AS positive, count(*) FILTER (WHERE value < 0) AS negative, count(*) FILTER (WHERE value > 200) AS very_high,
    count(*) FILTER (WHERE value > 100) AS high, count(*) FILTER (WHERE value > 50 AND value <= 100) AS medium, count(*) FILTER (WHERE value <= 50) AS low FROM events""",
)
def threshold_counts(spark, sf):
    return profile.threshold_counts(table(spark, sf, "events"), "value")


@query(
    "size_classes",
    """SELECT CASE WHEN n <= 3 THEN 'small' WHEN n <= 5 THEN 'medium' ELSE 'large' END AS size_class, count(*) AS customers, round(avg(m), 4) AS mean_price
    FROM (SELECT o_custkey, count(*) AS n, avg(o_totalprice) AS m FROM orders GROUP BY 1) GROUP BY 1""",
)
def size_classes(spark, sf):
    per = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.avg("o_totalprice").alias("m"))
    out = profile.grouped_means(per.withColumn("size_class", profile.size_class(F.col("n"))), ["size_class"], {"m": "mean_price"})
    counts = profile.value_counts(per.withColumn("size_class", profile.size_class(F.col("n"))), "size_class", "customers")
    return counts.join(out.withColumn("mean_price", F.round("mean_price", 4)), "size_class")


@query(
    "suburb_rollup",
    """WITH e AS (SELECT user_id AS suburb, round(value * 100) AS rental_price, event_type AS property_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(day(ts) AS INTEGER) AS quarter FROM events),
    m AS (SELECT suburb, property_type FROM e GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY suburb ORDER BY count(*) DESC, property_type) = 1),
    b AS (SELECT suburb, k FROM e GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY suburb ORDER BY count(*) DESC, k) = 1)
    SELECT suburb, avg(rental_price) AS rental_price, CAST(sum(e.k) AS BIGINT) AS count_k, avg(e.k) AS min_dist_k, any_value(m.property_type) AS property_type, any_value(b.k) AS best_k, quantile_cont(quarter, 0.5) AS quarter
    FROM e JOIN m USING (suburb) JOIN b USING (suburb) GROUP BY 1""",
)
def suburb_rollup(spark, sf):
    k = F.from_json("props", "k int")["k"]
    e = table(spark, sf, "events").select(
        F.col("user_id").alias("suburb"), cents("value").alias("rental_price"), F.col("event_type").alias("property_type"), k.alias("count_k"), k.alias("min_dist_k"), k.alias("best_k"), F.dayofmonth("ts").alias("quarter")
    )
    return score.suburb_rollup(e)


# --- series -----------------------------------------------------------------------------

SERIES = f"""SELECT c_mktsegment AS unit, CAST(make_date(year(o_orderdate), quarter(o_orderdate) * 3, 1) AS DATE) AS date, {QTR.format(d='o_orderdate')}, avg(round(o_totalprice * 100)) AS price
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3, 4"""


def segment_series(spark, sf):
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    s = panel.quarterly_rollup(o.withColumn("price", cents("o_totalprice")), "o_orderdate", ["price"], by=["c_mktsegment"])
    return s.withColumnRenamed("c_mktsegment", "unit").select("unit", "date", "year", "quarter", "price")


@query(
    "time_lags",
    f"SELECT *, lag(price, 1) OVER w AS lag_1, lag(price, 2) OVER w AS lag_2, lag(price, 3) OVER w AS lag_3, lag(price, 4) OVER w AS lag_4 FROM ({SERIES}) WINDOW w AS (PARTITION BY unit ORDER BY date)",
)
def time_lags(spark, sf):
    return panel.time_lags(segment_series(spark, sf), ["unit"], "date", "price", prefix="lag_")


@query("first_difference", f"SELECT unit, date, round(price - lag(price) OVER (PARTITION BY unit ORDER BY date), 4) AS diff FROM ({SERIES})")
def first_difference(spark, sf):
    d = panel.first_difference(segment_series(spark, sf), ["unit"], "date", "price")
    return d.select("unit", "date", F.round("diff", 4).alias("diff"))


@query(
    "tail4",
    f"SELECT unit, t1 AS oldest, t4 AS newest FROM (SELECT unit, max(price) FILTER (WHERE r = 4) AS t1, max(price) FILTER (WHERE r = 1) AS t4 FROM (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY date DESC) AS r FROM ({SERIES})) GROUP BY 1)",
)
def tail4(spark, sf):
    t = panel.tail_values(segment_series(spark, sf), ["unit"], "date", "price")
    return t.select("unit", F.col("tail")[0].alias("oldest"), F.col("tail")[3].alias("newest"))


@query("baseline", f"SELECT unit, arg_max(price, date) AS baseline_rent FROM ({SERIES}) GROUP BY 1 HAVING count(*) >= 2")
def baseline(spark, sf):
    return panel.baseline(segment_series(spark, sf), ["unit"], "date", "price")


@query(
    "recent_trend",
    f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY date DESC) AS r FROM ({SERIES})), d AS (SELECT unit, price, r, price - lag(price) OVER (PARTITION BY unit ORDER BY date) AS diff FROM r WHERE r <= 4)
    SELECT unit, max(price) FILTER (WHERE r = 1) AS last_value, round(avg(diff), 4) AS trend FROM d GROUP BY 1""",
)
def recent_trend(spark, sf):
    return panel.recent_trend(segment_series(spark, sf), ["unit"], "date", "price").withColumn("trend", F.round("trend", 4))


@query(
    "forward_fill",
    "SELECT user_id, event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_purchase FROM events",
)
def forward_fill(spark, sf):
    e = table(spark, sf, "events").withColumn("bought", F.when(F.col("event_type") == "purchase", F.col("value")))
    e = e.select("user_id", "event_id", "ts", "bought")
    out = ordering.forward_fill(e, ["user_id"], ["ts", "event_id"], "bought", "last_purchase")
    return out.select("user_id", "event_id", "last_purchase")


@query(
    "roll_lags",
    f"SELECT unit, max(price) FILTER (WHERE r = 3) AS oldest, 1e0 AS newest FROM (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY date DESC) AS r FROM ({SERIES})) GROUP BY 1",
)
def roll_lags(spark, sf):
    t = panel.tail_values(segment_series(spark, sf), ["unit"], "date", "price")
    r = panel.roll_lags(F.col("tail"), F.lit(1.0))
    return t.select("unit", r[0].alias("oldest"), r[3].alias("newest"))


# --- distributions and statistics -----------------------------------------------------


@query(
    "ecdf",
    "SELECT l_extendedprice, count(*) AS n, round(max(c), 10) AS ecdf FROM (SELECT l_extendedprice, cume_dist() OVER (ORDER BY l_extendedprice) AS c FROM lineitem) GROUP BY 1",
)
def ecdf(spark, sf):
    return profile.empirical_cdf(table(spark, sf, "lineitem"), "l_extendedprice").withColumn("ecdf", F.round("ecdf", 10))


@query(
    "percentiles",
    "SELECT l_returnflag, " + ", ".join(f"round(quantile_cont(l_quantity * l_extendedprice, {p / 100}), 4) AS q{p}" for p in (10, 25, 50, 75, 90, 95, 99)) + " FROM lineitem GROUP BY 1",
)
def percentiles(spark, sf):
    from leasegrid.operators.quantiles import exact_quantiles

    l = table(spark, sf, "lineitem").select("l_returnflag", (F.col("l_quantity") * F.col("l_extendedprice")).alias("v"))
    out = exact_quantiles(l, "v", [0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99], ["l_returnflag"])
    return out.select("l_returnflag", *[F.round(c, 4).alias(c) for c in out.columns[1:]])


@query(
    "correlations",
    """SELECT 'l_quantity' AS a, 'l_extendedprice' AS b, round(corr(l_quantity, l_extendedprice), 8) AS corr FROM lineitem
    UNION ALL SELECT 'l_quantity', 'l_discount', round(corr(l_quantity, l_discount), 8) FROM lineitem UNION ALL SELECT 'l_extendedprice', 'l_discount', round(corr(l_extendedprice, l_discount), 8) FROM lineitem
    UNION ALL SELECT 'l_quantity', 'l_quantity', 1e0 UNION ALL SELECT 'l_extendedprice', 'l_extendedprice', 1e0 UNION ALL SELECT 'l_discount', 'l_discount', 1e0""",
)
def correlations(spark, sf):
    return profile.correlations(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"]).withColumn("corr", F.round("corr", 8))


@query(
    "shape",
    """WITH m AS (SELECT l_returnflag, avg(l_extendedprice) OVER (PARTITION BY l_returnflag) AS m, l_extendedprice AS x FROM lineitem)
    SELECT l_returnflag, round(avg(pow(x - m, 3)) / pow(avg(pow(x - m, 2)), 1.5), 6) AS skewness, round(avg(pow(x - m, 4)) / pow(avg(pow(x - m, 2)), 2) - 3, 6) AS kurtosis FROM m GROUP BY 1""",
)
def shape(spark, sf):
    out = profile.shape(table(spark, sf, "lineitem"), "l_extendedprice", ["l_returnflag"])
    return out.withColumns({c: F.round(c, 6) for c in ("skewness", "kurtosis")})


@query(
    "line_fit",
    "SELECT l_linestatus, round(regr_slope(l_extendedprice, l_quantity), 6) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept FROM lineitem GROUP BY 1",
)
def line_fit(spark, sf):
    out = profile.line_fit(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", ["l_linestatus"])
    return out.select("l_linestatus", F.round("slope", 6).alias("slope"), F.round("intercept", 4).alias("intercept"))


@query(
    "anova",
    """WITH g AS (SELECT o_orderpriority, count(*) AS n, avg(o_totalprice) AS m, var_pop(o_totalprice) AS v FROM orders GROUP BY 1), t AS (SELECT sum(n) AS n, count(*) AS k, sum(n * m) / sum(n) AS mm FROM g)
    SELECT round((sum(g.n * (m - mm) * (m - mm)) / (any_value(k) - 1)) / (sum(g.n * v) / (any_value(t.n) - any_value(k))), 6) AS f_stat,
    CAST(any_value(k) - 1 AS DOUBLE) AS df_between, CAST(any_value(t.n) - any_value(k) AS DOUBLE) AS df_within FROM g, t""",
)
def anova(spark, sf):
    out = profile.anova(table(spark, sf, "orders"), "o_totalprice", "o_orderpriority")
    return out.select(F.round("f_stat", 6).alias("f_stat"), "df_between", "df_within")


@query(
    "histogram",
    """WITH b AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)
    SELECT CAST(least(floor((l_extendedprice - lo) / ((hi - lo) / 20)), 19) AS INTEGER) AS bin, count(*) AS n FROM lineitem, b GROUP BY 1""",
)
def histogram(spark, sf):
    return profile.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 20).select("bin", "n")


def _horner_sql(x, coefficients):
    out = repr(coefficients[-1]) + "::DOUBLE"
    for a in reversed(coefficients[:-1]):
        out = f"({out} * ({x}) + {a!r}::DOUBLE)"
    return out


def _normal_quantile_sql(p):
    from leasegrid.functions.numbers import AS241

    (cn, cd), (tn, td), (fn, fd) = AS241["central"], AS241["tail"], AS241["far"]
    r = f"0.180625::DOUBLE - ({p} - 0.5) * ({p} - 0.5)"
    t = f"sqrt(-ln(least({p}, 1 - {p})))"
    tail = f"{_horner_sql(t + ' - 1.6', tn)} / {_horner_sql(t + ' - 1.6', td)}"
    far = f"{_horner_sql(t + ' - 5', fn)} / {_horner_sql(t + ' - 5', fd)}"
    return (
        f"CASE WHEN abs({p} - 0.5) <= 0.425 THEN ({p} - 0.5) * {_horner_sql(r, cn)} / {_horner_sql(r, cd)} "
        f"ELSE sign({p} - 0.5) * CASE WHEN {t} <= 5 THEN {tail} ELSE {far} END END"
    )


@query(
    "normal_qq",
    f"""WITH r AS (SELECT c_custkey, c_acctbal, row_number() OVER (ORDER BY c_acctbal, c_custkey) AS i, count(*) OVER () AS n FROM customer),
    q AS (SELECT *, CASE WHEN i = n THEN pow(0.5e0, 1e0 / n) WHEN i = 1 THEN 1 - pow(0.5e0, 1e0 / n) ELSE (i - 0.3175e0) / (n + 0.365e0) END AS p FROM r)
    SELECT c_custkey, i, round({_normal_quantile_sql('p')}, 8) AS theoretical, c_acctbal AS ordered FROM q""",
)
def normal_qq(spark, sf):
    out = profile.normal_qq(table(spark, sf, "customer"), "c_acctbal", ["c_custkey"])
    return out.withColumn("theoretical", F.round("theoretical", 8))


@query(
    "rent_panel",
    f"""WITH w AS (SELECT o.*, n_name, year(o_orderdate) AS y, quarter(o_orderdate) AS q, CASE substr(o_orderpriority, 1, 1) WHEN '2' THEN round(o_totalprice, 2) / 4 WHEN '5' THEN NULL ELSE round(o_totalprice, 2) END AS rent
      FROM orders o JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
    k AS (SELECT * FROM w WHERE rent IS NOT NULL QUALIFY row_number() OVER (PARTITION BY o_custkey, y, q ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
    SELECT lower(n_name) AS suburb, CAST(y AS INTEGER) AS year, CAST(q AS INTEGER) AS quarter, round(quantile_cont(rent, 0.5), 6) AS median_rent, count(*) AS listings FROM k GROUP BY 1, 2, 3""",
)
def rent_panel(spark, sf):
    """Advertised prices to the quarterly median weekly rent per nation (latest ad per customer and quarter)."""
    from leasegrid.functions.text import weekly_rent
    from leasegrid.operators.quantiles import exact_median

    o = priced_orders(spark, sf).withColumn("rent", weekly_rent(F.col("price_text"))).where(F.col("rent").isNotNull())
    o = o.withColumns({"year": F.year("o_orderdate"), "quarter": F.quarter("o_orderdate")})
    o = o.select("o_custkey", "year", "quarter", "o_orderdate", "o_orderkey", "rent")
    latest = clean.keep_latest(o, ["o_custkey", "year", "quarter"], ["o_orderdate", "o_orderkey"])
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey", F.lower("n_name").alias("suburb"))
    rows = latest.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    keys = ["suburb", "year", "quarter"]
    counts = rows.groupBy(*keys).agg(F.count("*").alias("listings"))
    return exact_median(rows, "rent", keys, "median_rent").withColumn("median_rent", F.round("median_rent", 6)).join(counts, keys)
