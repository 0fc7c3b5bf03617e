"""Regression, selection, autoregression and the recursive forecast against plain numpy/Python."""

import math
import random
from datetime import date

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from leasegrid.operators import clean, forecast, linear, model, profile, score
from leasegrid.plans import liveability, schools
from leasegrid.queries import spatial_and_models, workflows  # noqa: F401
from leasegrid.queries.registry import QUERIES


def _xy(spark, n=400, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4)) * [1, 10, 100, 1] + [5, 0, 1000, 0]
    y = 3 + 2 * x[:, 0] - 0.5 * x[:, 1] + rng.normal(size=n)
    w = rng.uniform(0.1, 1, size=n)
    rows = [(i, *map(float, r), float(a), float(b)) for i, (r, a, b) in enumerate(zip(x, y, w))]
    return spark.createDataFrame(rows, "i int, a double, b double, c double, d double, y double, w double"), x, y, w


@pytest.mark.parametrize("weighted", [False, True])
def test_least_squares(spark, weighted):
    df, x, y, w = _xy(spark)
    fit = linear.least_squares(df, ["a", "b", "c", "d"], "y", "w" if weighted else None)
    ww = w if weighted else np.ones_like(y)
    design = np.column_stack([np.ones(len(y)), x])
    xtx = design.T @ (design * ww[:, None])
    beta = np.linalg.solve(xtx, design.T @ (ww * y))
    res = y - design @ beta
    cov = np.linalg.inv(xtx) * (ww @ res**2) / (len(y) - 5)
    assert fit.coefficients == pytest.approx(beta, rel=1e-6, abs=1e-9)
    assert fit.errors == pytest.approx(np.sqrt(np.diag(cov)), rel=1e-6)
    mean = (ww @ y) / ww.sum()
    assert fit.r2 == pytest.approx(1 - (ww @ res**2) / (ww @ (y - mean) ** 2), rel=1e-9)
    assert fit.p_values[1] < 1e-9 and fit.p_values[4] > 1e-4


def test_least_squares_allows_collinear_dummies(spark):
    df, *_ = _xy(spark)
    df = df.withColumns({"p": (F.col("i") % 2).cast("double"), "q": (1 - F.col("i") % 2).cast("double")})
    fit = linear.least_squares(df, ["a", "p", "q"], "y")
    plain = linear.least_squares(df, ["a", "p"], "y")
    both = df.select(fit.predict().alias("f"), plain.predict().alias("g")).agg(F.max(F.abs(F.col("f") - F.col("g")))).first()[0]
    assert both < 1e-6


def test_least_squares_with_257_columns(spark):
    """200 numbers and 57 dummies of one full set beside the intercept: rank 257 of 258."""
    rng = np.random.default_rng(2)
    n, names = 3000, [f"x{i}" for i in range(257)]
    x = np.concatenate([rng.normal(size=(n, 200)) * rng.uniform(0.01, 1000, 200), np.eye(57)[rng.integers(0, 57, n)]], 1)
    y = x[:, :200] @ rng.normal(size=200) + rng.normal(size=n)
    rows = [[float(v) for v in r] + [float(b)] for r, b in zip(x, y)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in [*names, "y"]))
    fit = linear.least_squares(df, names, "y")
    design = np.column_stack([np.ones(n), x])
    beta, *_ = np.linalg.lstsq(design, y, rcond=None)
    assert fit.rank == 257
    assert fit.coefficients[1:201] == pytest.approx(beta[1:201], rel=1e-6, abs=1e-7)
    res = y - design @ beta
    part = np.linalg.inv((lambda d: d.T @ d)(np.delete(design, 0, 1)))
    errors = np.sqrt(np.diag(part) * (res @ res) / (n - 257))
    assert fit.errors[1:201] == pytest.approx(errors[:200], rel=1e-6)


def test_pivoted_factor_finds_the_rank():
    rng = np.random.default_rng(1)
    a = rng.normal(size=(12, 5))
    inv, rank = linear.pseudo_inverse(a @ a.T)
    assert rank == 5 and np.allclose(inv, np.linalg.pinv(a @ a.T), atol=1e-8)
    assert linear.pseudo_inverse(np.zeros((3, 3)))[1] == 0


def test_lasso_path_meets_its_conditions():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 12))
    x[:, 5] = x[:, 4] * 0.999 + rng.normal(size=200) * 0.01
    x -= x.mean(0)
    y = x @ np.array([3, 0, -2, 0, 1, 1, 0, 0, 0, 0, 0.1, 0]) + rng.normal(size=200)
    xx, xy = x.T @ x / 200, x.T @ (y - y.mean()) / 200
    alphas = np.geomspace(np.abs(xy).max(), np.abs(xy).max() * 1e-3, 30)
    for alpha, step in zip(alphas, linear.lasso_path(xx, xy, alphas)):
        rest = xy - xx @ step.weights
        off = step.weights != 0
        assert np.allclose(rest[off], alpha * np.sign(step.weights[off]), atol=1e-8) and (np.abs(rest[~off]) <= alpha + 1e-8).all()
        assert step.violation <= 1e-10
    # too few sweeps are told, not hidden
    assert linear.lasso_path(xx, xy, alphas[-1:], most_sweeps=1)[0].violation > 1e-10


def test_lasso_keeps_signal_and_drops_noise(spark):
    df, x, y, _ = _xy(spark)
    fit = linear.lasso_select(df, ["a", "b", "c", "d"], "y", ["i"])
    alpha, coef = fit.penalty, fit.coefficients
    assert fit.converged and len(fit.errors) == 100
    z = (x - x.mean(0)) / x.std(0)
    # optimality conditions of the chosen penalty
    w = np.array(list(coef.values()))
    grad = z.T @ (y - y.mean() - z @ w) / len(y)
    for g, b in zip(grad, w):
        assert abs(g - alpha * np.sign(b)) < 1e-6 if b else abs(g) <= alpha + 1e-9
    assert coef["a"] > 1 and coef["b"] < -4


def test_anova_p_value(spark):
    rows = [("a", v) for v in (6.0, 8, 4, 5, 3, 4)] + [("b", v) for v in (8.0, 12, 9, 11, 6, 8)] + [("c", v) for v in (13.0, 9, 11, 8, 7, 12)]
    out = profile.anova(spark.createDataFrame([(g, float(v)) for g, v in rows], "g string, v double"), "v", "g").first()
    assert out.f_stat == pytest.approx(9.264706, abs=1e-5)
    assert out.p_value == pytest.approx(0.0023987, abs=1e-6)


def test_var_follows_its_recursion(spark):
    rng = random.Random(1)
    x = [(1.0, 2.0), (1.2, 1.9)]
    for _ in range(30):
        a, b = x[-1]
        x.append((0.5 * a + 0.2 * b + 0.1 + rng.gauss(0, 0.1), 0.3 * b + 0.6 + rng.gauss(0, 0.1)))
    rows = [("u", 2010 + i // 4, i % 4 + 1, *v) for i, v in enumerate(x)] + [("short", 2010, 1, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "g string, year int, quarter int, a double, b double")
    got = forecast.var_forecast(df, ["a", "b"], ["g"], steps=5).orderBy("step").collect()
    assert [r.step for r in got] == [1, 2, 3, 4, 5] and {r.g for r in got} == {"u"}
    arr = np.array(x)
    design = np.array([[1, *arr[t - 1], *arr[t - 2]] for t in range(2, len(arr))])
    beta = np.linalg.lstsq(design, arr[2:], rcond=None)[0]
    nxt = np.array([1, *arr[-1], *arr[-2]]) @ beta
    mean, std = arr.mean(0), arr.std(0, ddof=1)
    nxt = np.clip(nxt, np.maximum(arr.min(0), mean - 2 * std), np.minimum(arr.max(0), mean + 2 * std))
    assert [got[0].a, got[0].b] == pytest.approx(list(nxt), rel=1e-8)


@pytest.mark.parametrize("latest_first, renormalise, same_type", [(True, True, False), (False, False, False), (True, True, True)])
def test_spatial_forecast_matches_a_loop(spark, latest_first, renormalise, same_type):
    rng = random.Random(2)
    units = [(s, t) for s in "abcd" for t in ("1 bedroom flat", "2 bedroom house")] + [("e", "1 bedroom flat")]
    panel = []
    for s, t in units:
        for q in range(5 if s != "d" else 3):
            panel.append((s, t, date(2023, 3 * (q % 4) + 1, 1) if q < 4 else date(2024, 1, 1), rng.uniform(200, 500), rng.uniform(200, 500), 900.0))
    weights = {("a", "b"): 0.7, ("a", "c"): 0.3, ("b", "a"): 1.0, ("c", "d"): 0.4, ("c", "a"): 0.6}
    coef = {"const": 0.3, "log_rent_lag_1": 0.5, "log_rent_lag_2": 0.2, "log_rent_lag_3": 0.1, "log_rent_lag_4": 0.05, "log_spatial_lag": 0.08, "cpi": 0.01, "median_personal_income": 1e-5, "property_1 bedroom flat": -0.02}
    cpi = {1: 2.0, 2: 3.0, 3: 4.0}
    df = spark.createDataFrame(panel, "suburb string, property_type string, date date, median_rent double, spatial_lag double, median_personal_income double")
    edges = spark.createDataFrame([(*k, v) for k, v in weights.items()], "src string, dst string, w double")
    eco = spark.createDataFrame(list(cpi.items()), "step int, cpi double")
    out = forecast.spatial_forecast(df, edges, coef, eco, ["cpi"], 3, latest_first=latest_first, renormalise=renormalise, same_type=same_type)
    got = {(r.suburb, r.property_type, r.quarter): r.prediction for r in out.collect()}

    hist = {u: [r for r in panel if r[:2] == u] for u in units}
    live = {u: [math.log(r[3]) for r in h[-4:]] for u, h in hist.items() if len(h) >= 4}
    lag = {u: hist[u][-1][4] for u in live}
    want, pred = {}, {}
    for step in cpi:
        if step > 1:
            for s, t in live:
                total = norm = 0.0
                for (i, j), w in weights.items():
                    near = [p for (a, b), p in pred.items() if a == j and (b == t or not same_type)]
                    if i == s and near:
                        total, norm = total + w * sum(near) / len(near), norm + w
                lag[(s, t)] = (total / norm if renormalise else total) if norm else 0.0
        new = {}
        for u, lags in live.items():
            order = lags[::-1] if latest_first else lags
            y = 0.3 + sum(coef[f"log_rent_lag_{k + 1}"] * v for k, v in enumerate(order))
            y += 0.08 * math.log(max(lag[u], 1e-10)) + 0.01 * cpi[step] + 1e-5 * 900 + (-0.02 if u[1] == "1 bedroom flat" else 0)
            new[u] = math.exp(y)
            live[u] = lags[1:] + [y]
            want[(*u, step)] = new[u]
        pred = new
    assert set(got) == set(want)
    assert all(got[k] == pytest.approx(v, rel=1e-9) for k, v in want.items())
    growth = forecast.rent_growth(out, df, 3, 0.75).collect()
    assert len(growth) == len(live)


def _short_panel(spark, quarters=6):
    rows = [(s, "flat", date(2022 + q // 4, 3 * (q % 4) + 1, 1), 300.0 + 10 * q + len(s), 310.0 + 5 * q, 900.0) for s in ("a", "bb") for q in range(quarters)]
    df = spark.createDataFrame(rows, "suburb string, property_type string, date date, median_rent double, spatial_lag double, median_personal_income double")
    edges = spark.createDataFrame([("a", "bb", 1.0), ("bb", "a", 1.0)], "src string, dst string, w double")
    economy = spark.createDataFrame([(s, 2.0) for s in range(1, 6)], "step int, cpi double")
    return df, edges, economy


COEF = {"const": 0.1, "log_rent_lag_1": 0.7, "log_rent_lag_2": 0.2, "log_spatial_lag": 0.08, "cpi": 0.001}


def test_forecast_goes_on_from_its_state(spark, tmp_path, monkeypatch):
    """A run that stops after two quarters is started again and ends like one that never stopped."""
    df, edges, economy = _short_panel(spark)
    whole = {(r.suburb, r.quarter): r.prediction for r in forecast.spatial_forecast(df, edges, COEF, economy, ["cpi"], 5).collect()}
    path, seen = str(tmp_path / "state"), []
    lag = forecast.spatial_lag

    def stopping(current, *rest):
        seen.append(1)
        if len(seen) == 3:
            raise RuntimeError("stopped")
        return lag(current, *rest)

    monkeypatch.setattr(forecast, "spatial_lag", stopping)
    with pytest.raises(RuntimeError):
        forecast.spatial_forecast(df, edges, COEF, economy, ["cpi"], 5, state_path=path)
    again = forecast.spatial_forecast(df, edges, COEF, economy, ["cpi"], 5, state_path=path)
    assert forecast._finished(spark, path, next(iter({r.about for r in spark.read.parquet(f"{path}/done").collect()}))) == {0, 1, 2, 3, 4, 5}
    assert {(r.suburb, r.quarter): r.prediction for r in again.collect()} == pytest.approx(whole)
    # the quarters stored before the stop were written once
    assert spark.read.parquet(f"{path}/done").count() == 6
    with pytest.raises(ValueError, match="another forecast"):
        forecast.spatial_forecast(df, edges, {**COEF, "const": 0.2}, economy, ["cpi"], 5, state_path=path)


def test_short_histories_say_so(spark):
    df, edges, economy = _short_panel(spark, 3)
    with pytest.raises(ValueError, match="no unit has 4 rows"):
        forecast.spatial_forecast(df, edges, COEF, economy, ["cpi"], 2)
    with pytest.raises(ValueError, match="no step 6 of 8"):
        forecast.spatial_forecast(_short_panel(spark)[0], edges, COEF, economy, ["cpi"], 8)
    few = spark.createDataFrame([(2020 + i // 4, i % 4 + 1, float(i), float(i * i % 7)) for i in range(12)], "year int, quarter int, a double, b double")
    assert forecast.var_forecast(few.where("year < 2022"), ["a", "b"]).count() == 0
    told = forecast.var_forecast(few, ["a", "b"], steps=2).collect()
    assert {r.method for r in told} == {"var"} and len(told) == 2
    wide = few.withColumns({c: F.col("a") * k for k, c in enumerate("cdefgh", 2)})
    assert {r.method for r in forecast.var_forecast(wide, list("abcdefgh"), steps=2).collect()} == {"trend"}
    # the first value of a period by an explicit order, and the limits of a rate
    many = few.withColumn("cpi_rate", F.col("a") * 3).withColumn("rank", F.lit(1))
    late = many.withColumns({"cpi_rate": F.lit(99.0), "rank": F.lit(2)})
    out = forecast.var_forecast(many.unionByName(late), ["cpi_rate"], steps=4, first_by=["rank"]).collect()
    assert all(r.cpi_rate <= 10 for r in out)


def test_trees_and_importances(spark, tmp_path):
    df, *_ = _xy(spark, 300)
    df = df.withColumns({"kind": F.when(F.col("i") % 5 == 0, None).otherwise(F.concat(F.lit("k"), F.col("i") % 3)), "val": F.col("i") % 4 == 0})
    stages = model.preprocessor(df, ["a", "b"], ["kind"]) + [model.boosted_trees("y", validation="val", maxIter=8, maxDepth=3, stepSize=0.3)]
    fitted = Pipeline(stages=stages).fit(df)
    scored = fitted.transform(df.withColumn("kind", F.lit("never seen")))
    top = model.importances(fitted, scored, 2).collect()
    assert {r.feature for r in top} == {"a__i", "b__i"}
    model.save_model(fitted, str(tmp_path / "m"))
    again = model.load_model(str(tmp_path / "m")).transform(df)
    assert model.regression_metrics(again, "y", "prediction").first().r2 > 0.7


def test_rows_of_a_tree_fit_are_hashed_once(spark, tmp_path):
    """Fits pass over their rows many times: the split must not be worked out from the files each time."""
    rows = [(None if i == 0 else i, i % 7, 1.0 + i, 0.1, None if i % 9 == 0 else 0.2, "AB"[i % 2], 10.0 + i) for i in range(200)]
    names = ["l_orderkey", "l_partkey", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_extendedprice"]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_quantity double, l_discount double, l_tax double, l_returnflag string, l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = spatial_and_models._tree_rows(spark, str(tmp_path))
    assert "FileScan" not in got._jdf.queryExecution().executedPlan().toString()
    split = clean.hash_split(spark.createDataFrame(rows, names), "l_orderkey", {"train": 0.45, "val": 0.15, "test": 0.4})
    want = {(r.l_quantity, r.l_discount, r.l_tax, r.l_returnflag, r.split) for r in split.collect()}
    have = got.collect()
    assert len(have) == 200 and {(r.l_quantity, r.l_discount, r.l_tax, r.l_returnflag, r.split) for r in have} == want
    assert all(r.y == pytest.approx(math.log1p(r.l_quantity + 9)) and r.is_val == (r.split == "val" if r.split else None) for r in have)


def test_minmax_constant_and_empty(spark):
    df = spark.createDataFrame([(1, 2.0, None), (2, 2.0, None), (3, None, None)], "suburb int, a double, b double")
    got = score.minmax(df, {"x": "a", "y": "b", "z": "CAST(suburb AS DOUBLE)"}).orderBy("suburb").collect()
    assert [r.x for r in got] == [0.5] * 3 and [r.y for r in got] == [None] * 3 and [r.z for r in got] == [0.0, 0.5, 1.0]


def test_liveability_workflow(spark):
    rows = [("north melb", 400.0, "house", 2, 100.0, 0.4), ("carlton", 500.0, "flat", 5, None, 0.3), ("carlton", 600.0, "flat", None, 50.0, 0.5)]
    df = spark.createDataFrame(rows, "suburb string, rental_price double, property_type string, count_police int, min_dist_police double, income_rent_ratio double")
    aliases = spark.createDataFrame([("north melb", "north melbourne-west")], "alias string, canonical string")
    out = liveability.suburb_scores(df, aliases).select("suburb", "count_police", "pillar_s", "pillar_c", "livability_score")
    got = {r.suburb: r for r in out.collect()}
    assert got["carlton"].count_police == 5 and got["carlton"].pillar_c == 0.5 and got["carlton"].livability_score is None
    assert set(got) == {"carlton", "north melbourne-west"}


def test_school_workflow(spark):
    cols = "School_Name string, Education_Sector string, School_Type string, School_Status string, establishment_year int, X string, Y string, School_No int"
    base = [
        ("Good High", "Gov", "Secondary", "O", 2023, "144.95", "-37.80", 1),
        ("Good High", "Gov", "Secondary", "O", 2024, "144.951", "-37.801", 2),
        ("Late College", "Gov", "Secondary", None, 2025, "144.951", "-37.80", 3),
        ("Closed", "Gov", "Primary", "C", 2023, "144.95", "-37.80", 4),
        ("Bush Camp", "Gov", "Camp", "O", 2023, "144.95", "-37.80", 5),
    ]
    ranks = spark.createDataFrame([("Good High", "3"), ("Late College", "1")], "school_name string, vic_secondary_rank string")
    square = "POLYGON ((144.9 -37.9, 145.0 -37.9, 145.0 -37.7, 144.9 -37.7, 144.9 -37.9))"
    far = "POLYGON ((140 -30, 141 -30, 141 -29, 140 -30))"
    listings = spark.createDataFrame([(1, 2024, -37.8, 144.95, far, square), (2, 2025, -37.8, 144.95, None, square)], "property_id int, year int, lat double, lon double, walking_5min string, driving_5min string")
    bands = ["walking_5min", "driving_5min"]
    good = schools.ranked(schools.process_schools(spark.createDataFrame(base, cols)), ranks)
    assert {r.school_name for r in good.collect()} == {"Good High", "Late College"}
    got = {r.property_id: r for r in schools.school_features(listings, spark.createDataFrame(base, cols), ranks, bands).collect()}
    assert got[1].best_school_name_driving_5min == "Good High" and got[2].best_school_name_driving_5min == "Late College"
    assert got[1].n_schools_driving_5min == 1 and got[2].n_schools_driving_5min == 2
    assert got[1].best_school_name_walking_5min == "Good High" and got[1].n_schools_walking_5min == 1


def test_training_rows_are_spread(spark, monkeypatch, tmp_path):
    df = spark.range(0, 1000, 1, 1)
    spread = model.spread_rows(df, 100)
    sizes = [r["count"] for r in spread.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 1000 and max(sizes) <= 200 and spread.rdd.getNumPartitions() == 10
    assert model.spread_rows(df, 1000) is df
    p = df.select(F.col("id").alias("p_partkey"), (F.col("id") % 50).cast("int").alias("p_size"), F.concat(F.lit("Brand#"), F.col("id") % 5).alias("p_brand"), (F.col("id") / 10).alias("p_retailprice"))
    p.write.parquet(f"{tmp_path}/part.parquet")
    used, real = [], model.spread_rows
    monkeypatch.setattr(model, "spread_rows", lambda rows: used.append(rows) or real(rows, 100))
    out = QUERIES["saved_model"](spark, str(tmp_path)).first()
    assert used and (out.n, out.differing) == (1000, 0)


def test_growth_inputs_make_no_pairs(spark, tmp_path):
    rng = random.Random(5)
    orders = [(i, rng.choice([None, *range(120)]), rng.choice("FOP"), rng.choice([None, 10.0, 25.5, 70.25]), date(1995 + i % 2, 1 + i % 12, 3)) for i in range(300)]
    names = [(i, f"S{i // 2}", i % 3, rng.choice([None, 5.0, -8.5])) for i in range(130)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate date").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(names, "s_suppkey long, s_name string, s_nationkey int, s_acctbal double").write.parquet(f"{tmp_path}/supplier.parquet")
    p, _ = spatial_and_models._growth_inputs(spark, str(tmp_path))
    assert p._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") >= 3
    sums = {}
    for _, c, kind, price, day in orders:
        for k, name, _, balance in names:
            if c is not None and c % 50 == k % 50:
                s = sums.setdefault((name.lower(), kind, date(day.year, (day.month + 2) // 3 * 3, 1)), ([], []))
                s[0].extend([] if price is None else [price])
                s[1].extend([] if balance is None else [balance])
    got = {(r.suburb.lower(), r.property_type, r.date): (r.median_rent, r.median_personal_income) for r in p.collect()}
    assert set(got) == set(sums)
    for k, pair in got.items():
        for a, b in zip(pair, sums[k]):
            assert (a is None) == (not b) and (a is None or math.isclose(a, sum(b) / len(b), rel_tol=1e-12))


def test_the_search_is_run_whole(spark, monkeypatch, tmp_path):
    """Draws, folds, rounds and depths of the registered search: 20 draws, 5 folds, 1,000 rounds unless the validation rows end them, depth up to the default."""
    rows = [(i, i % 7, float(i % 50), i % 11 / 100, 0.02, "ANR"[i % 3], 900.0 + i % 50 * 20) for i in range(300)]
    columns = "l_orderkey long, l_partkey long, l_quantity double, l_discount double, l_tax double, l_returnflag string, l_extendedprice double"
    spark.createDataFrame(rows, columns).write.parquet(f"{tmp_path}/lineitem.parquet")
    asked = []

    class Stop(Exception):
        pass

    def recorded(**kw):
        asked.append(kw)
        raise Stop

    drawn = []
    monkeypatch.setattr(model, "CrossValidator", recorded)
    monkeypatch.setattr(model.random, "Random", lambda seed, made=random.Random: type("Counted", (made,), {"choice": lambda self, xs: drawn.append(xs) or made.choice(self, xs)})(seed))
    with pytest.raises(Stop):
        spatial_and_models.random_search(spark, str(tmp_path))
    gbt = asked[0]["estimator"].getStages()[-1]
    assert len(drawn) == 20 * 2 and asked[0]["numFolds"] == 5
    assert gbt.getMaxIter() == 1000 and gbt.getValidationIndicatorCol() == "is_val" and gbt.getValidationTol() == 0
    grid = [tuple(sorted((p.name, v) for p, v in m.items())) for m in asked[0]["estimatorParamMaps"]]
    assert len(grid) == len(set(grid)) > 6 and ("maxDepth", 6) in {x for m in grid for x in m}
