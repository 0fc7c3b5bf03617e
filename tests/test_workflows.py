"""Listing and panel workflows on hand-written rows."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from leasegrid.operators import joins
from leasegrid.plans import listings, rent_growth


def _archive(spark):
    schema = (
        "property_id long, url string, rental_price string, bedrooms int, bathrooms int, car_spaces int, property_type string, land_area int, "
        "property_features string, suburb string, postcode string, scraped_date string, wayback_url string, wayback_time string, year int, quarter int"
    )
    rows = []
    for i in range(12):
        rows.append((i, f"/{i}-1-main-road-carlton-vic-3053-{i}", "$400 pw", 2, 1, None if i == 3 else 1, "House", 0, "", "CARLTON", "3053", "", "", "20220418045210", 2022, 1))
    rows.append((0, "/0-1-main-road-carlton-vic-3053-0", "$1,800 pm", 2, 1, 1, "House", 0, "", "carlton", "3053", "", "", "20230618045210", 2023, 2))
    rows.append((1, "/1-1-main-road-carlton-vic-3053-1", "call us", 2, 1, 1, "House", 0, "", "carlton", "3053", "", "", "20230618045210", 2023, 2))
    rows.append((50, "/5-x-vic-3000-50", "$300", 1, 1, 1, "Flat", 0, "", "rare", "3000", "", "", "20230618045210", 2023, 2))
    return spark.createDataFrame(rows, schema)


def test_archive(spark):
    aliases = spark.createDataFrame([("carlton", "carlton north-carlton")], "alias string, canonical string")
    out = listings.clean_archive(_archive(spark), aliases)
    got = {r.property_id: r for r in out.collect()}
    assert set(got) == set(range(12))
    assert (got[0].rental_price, got[0].year, got[0].suburb) == (450.0, 2023, "carlton north-carlton")
    assert (got[1].rental_price, got[1].year) == (400.0, 2022)
    assert got[3].car_spaces == 1
    assert got[2].address == "1 Main Road, Carlton, VIC 3053"


def test_live_and_combination(spark):
    schema = (
        "`Property ID` double, property_features string, description string, property_type string, suburb string, rental_price string, "
        "appointment_only boolean, updated_date string, first_listed_date string, last_sold_date string, latitude double, longitude double, bedrooms string"
    )
    rows = []
    for i in range(12):
        kind = "Apartment / Unit / Flat" if i % 2 else "House"
        rows.append((100.0 + i, "−, ,1, ,1," if i == 4 else "3, ,1, ,1,", "nice", kind, "Fitzroy", f"${400 + i} per week", None if i == 5 else True, "2025-09-0%d" % (i % 9 + 1), None, None, -37.8, 144.9, "x"))
    rows.append((None, "3, ,1, ,1,", "no id", "House", "Fitzroy", "$1", True, "2025-09-01", None, None, -37.8, 144.9, "x"))
    rows.append((200.0, "3, ,1, ,1,", "wrong type", "Rural", "Fitzroy", "$500", True, "2025-09-01", None, None, -37.8, 144.9, "x"))
    live = listings.clean_live(spark.createDataFrame(rows, schema))
    got = {r.property_id: r for r in live.collect()}
    assert set(got) == {100 + i for i in range(12)}
    assert got[104].bedrooms == 3 and got[105].appointment_only is True
    assert (got[101].house_flat_other, got[100].house_flat_other) == ("flat", "house")
    assert (got[100].year, got[100].quarter, got[100].rental_price) == (2025, 3, 400.0)
    finished = listings.finish_live(live)
    assert "bedrooms" in finished.columns and "house_flat_other" not in finished.columns

    archive = listings.clean_archive(_archive(spark))
    geocodes = spark.createDataFrame([(i, "a", 144.0, -37.0, i != 7) for i in range(12)], "property_id long, address string, longitude double, latitude double, geocode_success boolean")
    both = listings.combine(live, archive, geocodes)
    kept = {r.property_id for r in both.collect()}
    # the dearest row is above the upper cut, and of the rest the cheapest equals the lower quantile
    assert 7 not in kept and 0 not in kept and 111 in kept and len(kept) <= 22
    assert listings.sample(both).count() <= both.count()


def test_enrich(spark):
    base = spark.createDataFrame([(1, "a", 0.0, 0.0), (2, "a", 0.0, 0.1), (3, "b", 5.0, 5.0)], "property_id long, suburb string, lat double, lon double")
    pois = spark.createDataFrame([(1, 2, 30.0, None), (2, 1, None, None)], "property_id long, count_cafe int, min_dist_cafe double, count_rare int")
    routes = spark.createDataFrame([(2, 7, 100.0, 10.0)], "property_id long, stationid int, min_route_dist_m double, min_route_dur_s double")
    iso = spark.createDataFrame([(1, "POLYGON 1", None), (2, "POLYGON 2", "POLYGON 3")], "property_id long, driving_5min string, driving_10min string")
    got = {r.property_id: r for r in listings.enrich(base, pois, routes, [iso]).collect()}
    assert got[3].count_cafe_imputed == 0 and "count_rare" not in got[3].asDict()
    assert got[2].min_dist_cafe_imputed == 30.0 and got[3].min_dist_cafe_imputed == 30.0
    assert got[1].closest_ptv_station_id_imputed == 7 and got[3].min_route_dur_s_imputed == 10.0
    assert (got[1].driving_5min_imputed, got[1].driving_10min_imputed) == ("POLYGON 1", "POLYGON 3")


def test_panel_to_growth(spark):
    rows = []
    for s, k in (("a-b", 1.0), ("c", 1.3), ("d", 0.8)):
        for t, m in (("1 bedroom flat", 1.0), ("2 bedroom house", 1.5)):
            for i in range(24):
                rows.append((s, t, i % 4 + 1, 2018 + i // 4, 300 * k * m * 1.01**i * (1 + 0.02 * ((i * 7 + len(s)) % 5))))
    rents = spark.createDataFrame(rows, "suburb string, property_type string, quarter int, year int, median_rent double")
    eco = [(date(2018 + i // 4, (i % 4 + 1) * 3, 1), 2018 + i // 4, i % 4 + 1, 2 + i * 0.1 + (i * 13 % 7) * 0.05, 1.0 + (i * 5 % 11) * 0.03) for i in range(24)]
    price = spark.createDataFrame([(d, y, q, c) for d, y, q, c, _ in eco], "date date, year int, quarter int, `CPI (%/y)` double")
    activity = spark.createDataFrame([(d, y, q, g) for d, y, q, _, g in eco], "date date, year int, quarter int, `GSP quarterly components (%/y)` double")
    economy = rent_growth.economic_series([price, activity])
    assert {"cpi", "gsp", "quarter_id"} <= set(economy.columns) and economy.count() == 24
    people = spark.createDataFrame([("Total", 100, "A"), ("Total", 300, "B"), ("Total", 50, "C (Vic.)"), ("Total", 70, "D"), ("20", 5, "A")], "`Age group` string, Persons long, Suburb string")
    stats = ["Median total personal income ($/weekly)", "Median age of persons"]
    medians = spark.createDataFrame([(s, v, n) for s in stats for n, v in (("A", 10.0), ("B", 20.0), ("C (Vic.)", 30.0), ("D", 40.0))], "Statistic string, Value double, Suburb string")
    panel = rent_growth.panel(rents, economy, people, medians)
    sizes = {r.suburb: (r.population_size, r.median_age) for r in panel.select("suburb", "population_size", "median_age").distinct().collect()}
    assert sizes == {"a-b": (200.0, 15.0), "c": (50.0, 30.0), "d": (70.0, 40.0)}
    panel = rent_growth.indexed(panel)
    assert panel.agg(F.max("time_index"), F.max("spatial_index")).first() == (23, 5)
    places = spark.createDataFrame([("A", -37.0, 145.0), ("B", -37.1, 145.0), ("C", -37.0, 145.1), ("D", -37.1, 145.2)], "locality string, lat double, lon double")
    edges = rent_growth.spatial_edges(places, panel, 2)
    totals = [r.t for r in edges.groupBy("src").agg(F.sum("w").alias("t")).collect()]
    assert totals and all(t == pytest.approx(1.0) for t in totals)
    feats = rent_growth.featured(panel, edges)
    assert feats.count() == 6 * 20 and feats.where("is_unreliable").agg(F.max("weights")).first()[0] == 0.1
    fit, metrics = rent_growth.fit_log_model(feats, ["cpi"], split=date(2023, 1, 1))
    assert {r.split: r.r2 > 0.5 for r in metrics.collect()} == {"train": True, "test": True}
    out, growth = rent_growth.forecast_growth(feats, edges, fit.as_dict(), ["cpi"], 3)
    assert out.count() == 18 and growth.count() == 6
    assert {str(d[0]) for d in out.select("date").distinct().collect()} == {"2024-03-31", "2024-06-30", "2024-09-30"}


def test_null_keys_do_not_match(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "suburb string, v int")
    assert joins.semi(a, a, "suburb").count() == 1
