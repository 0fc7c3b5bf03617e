"""File and nested sources on small fixtures."""

import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from leasegrid import constants as C
from leasegrid.operators import reshape
from leasegrid.plans import census
from leasegrid.sources import files, nested
from leasegrid.streaming import ingest


def _write(path, body, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(body.encode(encoding))


def test_missing_file_raises(spark, tmp_path):
    with pytest.raises(AnalysisException):
        files.read_csv(spark, str(tmp_path / "none.csv"), "a string")
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        files.merge_batches(spark, str(tmp_path / "empty"))


def test_merge_batches_with_drifting_headers(spark, tmp_path):
    _write(tmp_path / "batch_0001.csv", 'id,name\n1,"a, b"\n')
    _write(tmp_path / "batch_0002.csv", "name,extra,id\nc,x,2\n")
    _write(tmp_path / "other.txt", "zzz\n")
    got = files.merge_batches(spark, str(tmp_path), "batch_*.csv")
    assert {(r.id, r["name"], r.extra) for r in got.collect()} == {("1", "a, b", None), ("2", "c", "x")}
    typed = files.merge_batches(spark, str(tmp_path), "batch_0001.csv", "id int, name string")
    assert [tuple(r) for r in typed.collect()] == [(1, "a, b")]


def test_headers_with_quotes_commas_and_marks(spark, tmp_path):
    _write(tmp_path / "a.csv", '\ufeffid,"name, full",note\r\n1,"say ""hi"", you",\r\n2,,""\r\n\r\n3,x\r\n')
    _write(tmp_path / "b.csv", '"name, full","id"\nid,4\n"name, full",5\n')
    _write(tmp_path / "c.csv", "id\n")
    got = {r.id: (r["name, full"], r.note) for r in files.merge_batches(spark, str(tmp_path)).collect()}
    assert got == {"1": ('say "hi", you', None), "2": (None, ""), "3": ("x", None), "4": ("id", None), "5": ("name, full", None)}
    semi = files.merge_batches(spark, str(tmp_path / "c.csv"), sep=";")
    assert semi.columns == ["id"] and semi.count() == 0


def test_a_header_belongs_to_its_whole_file(spark, tmp_path):
    """Files split over tasks: later splits find the header of their own file."""
    for name, head in (("a", "id,v"), ("b", "v,id")):
        rows = [f"{i},{i * 10}" if name == "a" else f"{i * 10},{i}" for i in range(4000)]
        _write(tmp_path / f"{name}.csv", "\n".join([head, *rows]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        got = files.merge_batches(spark, str(tmp_path)).agg(F.count("*"), F.count_if(F.col("v").cast("int") == 10 * F.col("id").cast("int"))).first()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert tuple(got) == (8000, 8000)


def test_a_stopped_stream_counts_rows_once(spark, tmp_path):
    """The sink fails after it has written its batch; the restarted query overwrites that batch."""
    for k in range(4):
        spark.range(10 * k, 10 * k + 10).write.mode("append").parquet(str(tmp_path / "land"))
    stream = lambda: ingest.landed_files(spark, str(tmp_path / "land"), "id long", "parquet", files_per_batch=2)
    path, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    write = ingest._batch_sink(path, lambda b: b)

    def failing(batch, batch_id):
        write(batch, batch_id)
        if batch_id == 1:
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        ingest.run_available(stream(), checkpoint, failing)
    spark.range(40, 45).write.mode("append").parquet(str(tmp_path / "land"))
    for _ in range(2):
        rows = ingest.ingest(stream(), path, checkpoint)
        assert sorted(r.id for r in rows.collect()) == list(range(45))


def test_keyed_scan_and_listing(spark, tmp_path):
    for n in ("rental_listings_2022_03", "rental_listings_2023_12", "rental_listings_2023_01"):
        _write(tmp_path / f"{n}.csv", "v\n1\n")
    df = files.with_file_period(files.read_csv(spark, str(tmp_path), "v int"))
    assert {(r.year, r.quarter) for r in df.collect()} == {(2022, 1), (2023, 4), (2023, None)}
    keyed = files.read_keyed(spark, str(tmp_path), "v int", limit=2)
    assert {r.file_key for r in keyed.collect()} == {"rental_listings_2022_03", "rental_listings_2023_01"}
    assert files.available_files(spark, str(tmp_path)).count() == 3


def test_encoding_is_chosen_per_file(spark, tmp_path):
    _write(tmp_path / "schools_2023.csv", "n,k\nÉcole,1\nplain,2\n", "utf-8")
    _write(tmp_path / "schools_2024.csv", "n,k\nÉcole,3\nplain,4\n", "latin-1")
    got = files.read_csv_any_encoding(spark, str(tmp_path), "n string, k int")
    assert {(r.n, r.k) for r in got.collect()} == {("École", 1), ("plain", 2), ("École", 3), ("plain", 4)}


def test_sinks(spark, tmp_path):
    df = spark.range(25).select(F.col("id"), (F.col("id") % 2).alias("g"))
    files.write_if_absent(df, str(tmp_path / "once"))
    files.write_if_absent(df.limit(1), str(tmp_path / "once"))
    assert files.read_csv(spark, str(tmp_path / "once"), "id long, g long").count() == 25
    files.write_parquet(df, str(tmp_path / "p"), partition_by=["g"], max_records=5)
    assert spark.read.parquet(str(tmp_path / "p")).count() == 25
    files.write_report(df, str(tmp_path / "r"), "json")
    assert spark.read.json(str(tmp_path / "r")).count() == 25
    frames, skipped = files.load_available(
        {"ok": lambda: spark.read.parquet(str(tmp_path / "p")), "no": lambda: spark.read.parquet(str(tmp_path / "x"))}
    )
    assert set(frames) == {"ok"} and set(skipped) == {"no"}


def test_geojson(spark, tmp_path):
    doc = {"type": "FeatureCollection", "features": [{"properties": {"STOP_ID": "7", "STOP_NAME": "A", "MODE": "TRAM"}, "geometry": {"type": "Point", "coordinates": [144.9, -37.8]}}]}
    _write(tmp_path / "stops.geojson", json.dumps(doc, indent=1))
    row = nested.read_geojson_points(spark, str(tmp_path / "stops.geojson")).first()
    assert (row.STOP_ID, row.MODE, row.lat, row.lon) == ("7", "TRAM", -37.8, 144.9)


def test_html_table_rules(spark):
    html = """<p></p><table class="x"><thead><tr><th>Date</th><th>CPI (%/y)</th><th>PPI</th></tr></thead>
    <tr><td>2020-03-01</td><td> 1.5 </td><td></td></tr><tr><td></td><td>9</td><td>9</td></tr>
    <tr><td>2020-06-01</td><td>n/a</td><td>2</td></tr><tr><td>2020-09-01</td><td><b>3</b></td><td>4</td></tr></table><table><tr><td>no</td></tr></table>"""
    df = spark.createDataFrame([(html,)], "html string")
    got = [(r.date_text, list(r["values"]), list(r.headers)) for r in nested.html_table(df, [1, 2]).collect()]
    heads = ["Date", "CPI (%/y)", "PPI"]
    assert got == [("2020-03-01", [1.5, None], heads), ("2020-09-01", [3.0, 4.0], heads)]
    assert [list(r["values"]) for r in nested.html_table(df, None).collect()] == [[1.5, None], [3.0, 4.0]]


def _sheet(file, sheet, rows):
    return [(file, sheet, r, c, str(v)) for r, row in rows.items() for c, v in row.items()]


def test_census_tables(spark):
    name = "SAL20495_population.xlsx"
    cells = _sheet(name, "G02", {0: {0: "t"}, 1: {0: "Carlton (SAL20495) 1.8 sq Kms"}, 4: {0: "Median age", 1: 30, 3: "Median rent", 4: 400}, 5: {0: "Average size", 1: 2.1}})
    cells += _sheet(name, "G04", {8: {0: "Age (years):"}, 10: {0: "0-4 years:", 1: 1, 2: 2, 3: 3, 5: "20", 6: 4, 7: 5, 8: 9, 10: "Total", 11: 6, 12: 7, 13: 13}})
    bands = lambda n, start: dict(enumerate(["L"] + [start] * n))
    cells += _sheet(name, "G17", {5: {1: "PERSONS"}, 7: {**bands(10, 1), 0: "$1-$149"}, 8: {**bands(10, 2), 0: "Total"}, 9: {1: 5}, 11: {0: "This table is"}})
    cells += _sheet(name, "G33", {4: {0: "Negative/Nil income"}, 5: {1: 9}, 6: {0: "$1-$149", 1: 1, 2: 2, 3: 3}, 8: {0: "Total", 1: 4, 2: 5, 3: 9}, 9: {0: "after", 1: 1}})
    dwell = {3: {0: "Occupied private dwellings:"}, 4: {0: "Separate house", 1: 5, 2: 6}, 5: {0: "Flat or apartment:"}, 6: {0: "In a block", 1: 1, 2: 2}, 7: {0: "Total", 1: 3, 2: 4}}
    dwell |= {8: {0: "Total occupied private dwellings", 1: 8, 2: 9}, 9: {0: "Unoccupied private dwellings", 1: 7}, 10: {0: "Total private dwellings", 1: 15}, 11: {0: "note", 1: 0}}
    cells += _sheet(name, "G36", dwell)
    cells += _sheet(name, "G49", {2: {1: "PERSONS"}, **{4 + i: {**bands(9, i), 0: f"level {i}"} for i in range(10)}, 20: {0: "This table is"}})
    cells += _sheet(name, "G60", {2: {1: "PERSONS"}, 4: {**bands(10, 3), 0: "15-19 years"}, 20: {0: "This table is"}})
    grid = spark.createDataFrame(cells, "file string, sheet string, row int, col int, value string")
    got = {k: [r.asDict() for r in v.collect()] for k, v in census.census_tables(grid).items()}
    assert {(r["Statistic"], r["Value"], r["Suburb"]) for r in got["median_stats"]} >= {("Median age", 30.0, "Carlton"), ("Median rent", 400.0, "Carlton"), ("Average size", 2.1, "Carlton")}
    assert {(r["Age group"], r["Persons"]) for r in got["population_breakdown"]} == {("0-4 years:", 3), ("20", 9), ("Total", 13)}
    assert {(r["Price Range"], r["85+"]) for r in got["personal_income"]} == {("$1-$149", 1), ("Total", 2)}
    assert {(r["Income"], r["Total"]) for r in got["household_income"]} == {("$1-$149", 3), ("Total", 9)}
    assert [r["Dwelling Type"] for r in sorted(got["dwelling_structure"], key=lambda r: (r["Persons"] is None, r["Persons"]))][:4] == ["Flat or apartment - In a block", "Flat or apartment - Total", "Separate house", "Total occupied private dwellings"]
    assert len(got["dwelling_structure"]) == 6
    assert {r["Highest Education Level"] for r in got["education_level"]} == {f"level {i}" for i in range(10) if i not in (4, 8)}
    assert [r["Not Stated"] for r in got["job_type"]] == [3]


def test_rent_series(spark):
    rows = {0: {0: "Moving annual median rent by suburb"}, 1: {2: "Mar 2000", 4: "Dec 2001", 6: "All"}, 2: {2: "Count", 3: "Median", 4: "Count", 5: "Median"}}
    rows |= {3: {0: "Inner", 1: "Carlton", 2: 10, 3: 165, 4: 9, 5: "-"}, 4: {1: "Group Total", 2: 1, 3: 2}, 5: {1: "Fitzroy-Collingwood", 2: 5, 3: "x", 4: 6, 5: 210.5}}
    cells = _sheet("f", "1 bedroom flat", rows) + _sheet("f", "All properties", rows)
    grid = spark.createDataFrame(cells, "file string, sheet string, row int, col int, value string")
    got = {tuple(r) for r in reshape.rent_series(grid).collect()}
    assert got == {("carlton", "1 bedroom flat", 1, 2000, 165.0), ("fitzroy-collingwood", "1 bedroom flat", 4, 2001, 210.5)}


def test_streams_resume_without_repeats(spark, tmp_path):
    land, out, mark = (str(tmp_path / n) for n in ("land", "out", "mark"))
    _write(tmp_path / "land" / "batch_0001.csv", "id,t,v\n1,2024-01-05 00:00:00,10\n2,2024-02-01 00:00:00,20\n")
    schema = "id int, t timestamp, v double"
    stream = lambda: ingest.landed_files(spark, land, schema)
    assert ingest.ingest(stream(), out, mark).count() == 2
    _write(tmp_path / "land" / "batch_0002.csv", "id,t,v\n1,2024-05-05 00:00:00,30\n")
    assert ingest.ingest(stream(), out, mark).count() == 3
    latest = ingest.latest_per_key(stream(), f"{out}2", f"{mark}2", ["id"], ["t"])
    assert {(r.id, r.v) for r in latest.collect()} == {(1, 30.0), (2, 20.0)}
    means = ingest.quarterly_means(stream(), f"{out}3", f"{mark}3", "t", "v")
    assert {(r.quarter, r.v, r.n) for r in means.collect()} == {(1, 15.0, 2), (2, 30.0, 1)}


def test_fixed_tables():
    assert len(C.INDICATOR_NAMES) == 18 and len(C.SCHOOL_COLUMNS) == 24
    assert abs(sum(w for w in C.PILLAR_WEIGHTS.values() if w > 0) - 1.02) < 1e-9
    assert os.path.basename(C.__file__) == "constants.py"
