"""Skew-safe building blocks against brute force, with one hot key or coordinate."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from leasegrid.operators import clean, ordering, profile, quantiles, reshape, spatial
from leasegrid.operators.quantiles import exact_quantiles


@pytest.mark.parametrize("accuracy", [10000, 50])
def test_quantiles(spark, accuracy):
    rng = random.Random(1)
    rows = [("hot", round(rng.gauss(0, 10), 2)) for _ in range(2000)]
    rows += [("same", 7.0)] * 1500 + [("small", float(i)) for i in range(3)] + [("one", 4.0), ("gap", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    ps = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
    got = {r[0]: r[1:] for r in exact_quantiles(df, "v", ps, ["g"]).collect()}
    for g in ("hot", "same", "small", "one"):
        want = np.quantile([v for k, v in rows if k == g], ps)
        assert got[g] == pytest.approx(list(want))
    assert "gap" not in got
    whole = exact_quantiles(df, "v", ps).first()
    assert list(whole) == pytest.approx(list(np.quantile([v for _, v in rows if v is not None], ps)))


def test_medians_and_descriptions_of_many_columns(spark):
    rng = random.Random(2)
    rows = [(f"g{i % 3}", float(rng.randint(0, 50)) if i % 5 else None, rng.gauss(0, 1) if i % 7 else float("nan"), i) for i in range(600)] + [(None, 1.0, 1.0, 1)]
    df = spark.createDataFrame(rows, "g string, a double, b double, c int")
    meds = {r.g: r for r in quantiles.exact_medians(df, ["a", "b", "c"], ["g"]).collect()}
    told = {(r.g, r.column): r for r in profile.describe_columns(df, ["a", "b", "c"], ["g"]).collect()}
    for g in ("g0", "g1", "g2"):
        for at, c in ((1, "a"), (2, "b"), (3, "c")):
            x = np.array([r[at] for r in rows if r[0] == g and r[at] is not None and r[at] == r[at]], float)
            assert meds[g][c] == pytest.approx(np.median(x))
            d = told[g, c]
            assert (d["count"], d.min, d.max) == (len(x), x.min(), x.max())
            assert [d.mean, d.std, d.q25, d.median, d.q75] == pytest.approx([x.mean(), x.std(ddof=1), *np.quantile(x, [0.25, 0.5, 0.75])])
    assert set(meds) == {"g0", "g1", "g2"}
    empty = profile.describe(df.where("g = 'none'"), "a", ["g"])
    assert empty.count() == 0


def test_one_hot_vector_has_no_limit(spark):
    train = spark.range(3000).select(F.format_string("v%04d", "id").alias("v"))
    model = reshape.one_hot_vector(train, "v", "hot")
    asked = spark.createDataFrame([("v0007",), ("new",), (None,)], "v string")
    got = [r.hot for r in model.transform(asked).collect()]
    assert [h.size for h in got] == [3000] * 3 and [list(h.indices) for h in got] == [[7], [], []]


def test_running_totals_and_row_numbers(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 7).alias("g"), F.lit(2).alias("w"))
    run = ordering.running_totals(df, ["id"], "w", name="c", total="t").collect()
    assert all(r.c == 2 * (r.id + 1) and r.t == 2000 for r in run)
    grouped = ordering.running_totals(df, ["id"], "w", ["g"], "c").collect()
    assert all(r.c == 2 * (r.id // 7 + 1) for r in grouped)
    numbered = ordering.row_numbers(df.orderBy(F.rand(1)), [F.col("id").desc()], "n").collect()
    assert all(r.n == 1000 - r.id for r in numbered)


def test_forward_fill_crosses_ranges(spark):
    rows = [("hot" if i % 10 else "cold", i, float(i) if i % 37 == 5 else None) for i in range(2000)]
    df = spark.createDataFrame(rows, "u string, i int, v double").repartition(5)
    got = {r.i: r.f for r in ordering.forward_fill(df, ["u"], ["i"], "v", "f").collect()}
    seen = {}
    for u, i, v in rows:
        seen[u] = v if v is not None else seen.get(u)
        assert got[i] == seen[u]


@pytest.mark.parametrize("bucket_rows", [100_000, 16])
def test_stratified_sample_is_exact(spark, bucket_rows):
    rows = [(i, "hot" if i % 3 else f"s{i % 50}") for i in range(3000)] + [(9999, "single"), (10000, None)]
    df = spark.createDataFrame(rows, "id int, s string")
    got = clean.stratified_sample(df, ["s"], "id", 0.5, bucket_rows=bucket_rows)
    counts = {r.s: r.n for r in got.groupBy("s").agg(F.count("*").alias("n")).collect()}
    sizes = {}
    for _, s in rows:
        sizes[s] = sizes.get(s, 0) + 1
    assert counts == {s: (round(n * 0.5) if n > 1 else n) for s, n in sizes.items() if round(n * 0.5) or n == 1}
    assert got.select("id").distinct().count() == got.count()


def _brute(points, sites, k, within, dist):
    out = set()
    for pid, plat, plon, pg in points:
        near = sorted((dist(plat, plon, slat, slon), sid) for sid, slat, slon, sg in sites if sg == pg)
        near = [n for n in near if within is None or n[0] <= within][:k]
        out |= {(pid, sid) for _, sid in near}
    return out


def _haversine(a, b, c, d):
    a, b, c, d = map(np.radians, (a, b, c, d))
    h = np.sin((c - a) / 2) ** 2 + np.cos(a) * np.cos(c) * np.sin((d - b) / 2) ** 2
    return 2 * 6371.0088 * np.arcsin(np.sqrt(h))


@pytest.mark.parametrize("method, within", [("haversine", None), ("haversine", 3.0), ("planar", None), ("planar", 0.05)])
def test_nearest_with_clusters_and_copies(spark, method, within):
    rng = random.Random(3)
    cluster = lambda n, lat, lon, s: [(lat + rng.gauss(0, s), lon + rng.gauss(0, s)) for _ in range(n)]
    spots = cluster(60, -37.8, 144.9, 0.005) + cluster(20, -38.6, 143.2, 0.3) + [(-37.81, 144.96)] * 40 + [(-36.0, 147.5)]
    sites = [(i, *xy, i % 2) for i, xy in enumerate(spots)]
    asks = cluster(40, -37.8, 144.9, 0.02) + cluster(25, -37.0, 145.0, 1.0) + [(-37.81, 144.96)] * 30
    points = [(1000 + i, *xy, i % 2) for i, xy in enumerate(asks)]
    schema = "id int, lat double, lon double, g int"
    got = spatial.nearest(
        spark.createDataFrame(points, schema), spark.createDataFrame(sites, schema).withColumnRenamed("id", "sid"), 4, "id", "sid", by=["g"], within=within, method=method
    )
    dist = _haversine if method == "haversine" else (lambda a, b, c, d: float(np.hypot(c - a, d - b)))
    assert {(r.id, r.sid) for r in got.collect()} == _brute(points, sites, 4, within, dist)


def test_nearest_over_wide_latitudes(spark):
    rng = random.Random(5)
    rows = [(i, rng.uniform(-5, 55), rng.uniform(0, 60), 0) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, lat double, lon double, g int")
    got = spatial.nearest(df, df.withColumnRenamed("id", "sid"), 3, "id", "sid")
    assert {(r.id, r.sid) for r in got.collect()} == _brute(rows, rows, 3, None, _haversine)


def test_imputation_keeps_known_cells_and_falls_back(spark):
    rows = [(1, "a", 0.0, 0.0, None, 1), (2, "a", 0.0, 1.0, 5, 2), (3, "a", 0.0, 0.4, 7, None), (4, "b", 0.0, 9.0, None, None), (5, "c", 0.0, 8.0, 9, 9)]
    df = spark.createDataFrame(rows, "id int, suburb string, lat double, lon double, x int, y int")
    got = {r.id: (r.x, r.y) for r in spatial.impute_nearest(df, ["x", "y"], "id").collect()}
    assert got == {1: (5, 1), 2: (5, 2), 3: (7, 2), 4: (9, 9), 5: (9, 9)}


def test_repeated_names_need_three_rows(spark):
    rows = [(1, "A", "x"), (2, "A", "x"), (3, "A", "x"), (4, "B", "x"), (5, "B", "x"), (6, "C", "x"), (7, "C", "y"), (8, "C", "z"), (9, None, "x")]
    df = spark.createDataFrame(rows, "id int, name string, g string")
    got = clean.drop_repeated_names(df, "name", ["g"], ["id"])
    assert {r.id for r in got.collect()} == {4, 5, 6, 7, 8, 9}


def test_mode_ties_and_null_groups(spark):
    rows = [("a", 2), ("a", 1), ("a", None), ("b", None), (None, None), (None, 3), ("c", 3)]
    df = spark.createDataFrame(rows, "t string, v int")
    got = sorted((str(r.t), r.v) for r in clean.impute_mode(df, "v", "t").collect())
    assert got == [("None", 3), ("None", 3), ("a", 1), ("a", 1), ("a", 2), ("b", 3), ("c", 3)]


@pytest.mark.parametrize("few", [True, False])
def test_mode_fill_of_few_hot_groups_stays_spread(spark, monkeypatch, few):
    """Rows of two groups keep their tasks when their modes are filled in; many groups give the same rows by exchange."""
    monkeypatch.setattr(clean, "FEW_GROUPS", 2 if few else 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        i = F.col("id")
        df = spark.range(0, 4000, 1, 8).select("id", (i % 2).alias("t"), F.when(i % 5 > 0, i % 2 + 7).alias("x"), F.when(i % 3 > 0, i % 2 * 10).alias("y"))
        for out, names in ((clean.impute_modes(df, ["x", "y"], "t"), ["x", "y"]), (clean.impute_mode(df, "x", "t"), ["x"])):
            got = out.withColumn("task", F.spark_partition_id()).collect()
            assert sorted(r.id for r in got) == list(range(4000))
            assert all(r.x == r.t + 7 for r in got)
            assert "y" not in names or all(r.y == r.t * 10 for r in got)
            assert not few or len({r.task for r in got}) == 8
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", ["knn_join", "radius_join", "nearest_donor", "point_in_polygon", "fuzzy_dedup", "nearest_snapshot", "spatial_lag"])
def test_no_nested_loops(spark, name):
    import __spark_entry__ as entry

    df = entry.queries()[name](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_quantiles_do_not_bring_a_group_to_one_task(spark, monkeypatch):
    frozen = []

    def recorded(df, cut=ordering.cut_lineage):
        frozen.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df)

    monkeypatch.setattr(ordering, "cut_lineage", recorded)
    df = spark.range(30_000).select((F.col("id") * 7919 % 30_011).cast("double").alias("v"), F.when(F.col("id") < 100, "short").otherwise("long").alias("g"))
    got = {r.g: (r.q25, r.q50) for r in quantiles.exact_quantiles(df, "v", [0.25, 0.5], ["g"], accuracy=1000).collect()}
    assert frozen and not any("SortMergeJoin" in p or "ShuffledHashJoin" in p for p in frozen)
    rows = df.toPandas()
    for g, pair in got.items():
        assert np.allclose(pair, np.quantile(rows.v[rows.g == g], [0.25, 0.5]), rtol=0, atol=1e-9)
    assert set(got) == {"short", "long"}
