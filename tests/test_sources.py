"""Readers, sinks, archives and artifacts."""

import zipfile

import pytest
from pyspark.sql import functions as F

from tabloom.operators import columns as C
from tabloom.operators import joins as J
from tabloom.operators import tables as TB
from tabloom.operators.profile import fill_median_category, median_category
from tabloom.plans import integrate as IN
from tabloom.sources import readers as RD
from tabloom.sources import sinks as SK


def test_csv_bom_header_and_nulls(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes("﻿ id , v \n1,NaN\n2,\n3,x\n".encode())
    df = RD.read_csv(spark, str(path))
    assert df.columns == ["id", "v"]
    assert [r["v"] for r in df.orderBy("id").collect()] == [None, None, "x"]


def test_read_any(spark, tmp_path):
    (tmp_path / "b.csv").write_text("k\n1\n")
    (tmp_path / "notes.txt").write_text("x")
    assert RD.read_any(spark, str(tmp_path)).count() == 1
    (tmp_path / "train.csv").write_text("k\n1\n2\n")
    assert RD.read_any(spark, str(tmp_path)).count() == 2
    empty = tmp_path / "empty"
    empty.mkdir()
    for bad, error in ((str(empty), FileNotFoundError), (str(tmp_path / "no"), FileNotFoundError), (str(tmp_path / "notes.txt"), ValueError)):
        with pytest.raises(error):
            RD.read_any(spark, bad)


def test_csv_quoting_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "q", b'), (2, "back\\slash"), (3, None)], "id int, t string")
    SK.write_csv(df, str(tmp_path / "q"))
    back = RD.read_csv(spark, str(tmp_path / "q"), "id int, t string", escape='"')
    assert sorted(back.collect()) == sorted(df.collect())


def test_members():
    assert RD.pick_member(["x/AUX_accident.csv", "z/Accident.CSV", "b.csv"], r"ACCIDENT\.CSV$") == "z/Accident.CSV"
    assert RD.pick_member(["b.csv"], "nothing") is None


def test_archives(spark, tmp_path):
    for year, age in ((2016, b"33"), (2017, b"\xe9")):  # the second is not UTF-8
        with zipfile.ZipFile(tmp_path / f"FARS{year}NationalCSV.zip", "w") as z:
            z.writestr("aux_accident.csv", "x\n1\n")
            z.writestr("ACCIDENT.CSV", "STATE,ST_CASE,COUNTY,LATITUDE,LONGITUD\n36,1,5,40.7,-74.0\n36,2,99,40.7,-74\n1,1,5,40,-74\n")
            z.writestr("vehicle.csv", f"STATE,ST_CASE,VEH_NO,MAKE\n36,1,1,{year}\n")
            z.writestr("person.csv", b"STATE,ST_CASE,VEH_NO,AGE,PER_TYP\n36,1,1," + age + b",1\n36,1,1,5,2\n")
    tables = RD.read_yearly(spark, str(tmp_path), IN.MEMBER_PATTERNS, {
        "accident": "STATE bigint, ST_CASE bigint, COUNTY bigint, LATITUDE double, LONGITUD double",
        "vehicle": "STATE bigint, ST_CASE bigint, VEH_NO bigint, MAKE bigint, BODY_TYP bigint",
        "person": "STATE bigint, ST_CASE bigint, VEH_NO bigint, AGE string, PER_TYP bigint"})
    rows = sorted(IN.slim_crashes(**tables).collect(), key=lambda r: r["YEAR"])
    # equal case numbers of different years stay apart
    assert [(r["YEAR"], r["MAKE"], r["DRIVER_AGE"], r["BODY_TYP"]) for r in rows] == [(2016, 2016.0, 33.0, None), (2017, 2017.0, None, None)]
    with pytest.raises(Exception, match="not found"):
        RD.read_zip_members(spark, str(tmp_path), "absent", "a string").count()


def test_area_filter_variants(spark):
    df = spark.createDataFrame([("40.7", "-74.0"), ("10", "-74.0"), ("x", "1")], "LATITUD string, LONGITUDE string")
    assert C.area_filter(df, "COUNTY", [5], ["LATITUDE", "LATITUD"], ["LONGITUD", "LONGITUDE"]).count() == 1
    with pytest.raises(KeyError):
        C.area_filter(df.drop("LATITUD"), "COUNTY", [5], ["LATITUDE", "LATITUD"], ["LONGITUD", "LONGITUDE"])


def test_lookup_keeps_rows(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "z"), (4, "a")], "id int, k string")
    lookup = spark.createDataFrame([("a", "second"), ("a", "first"), (None, "null")], "key string, name string")
    for limit in (100, 0):
        got = {r["id"]: r["name"] for r in J.lookup_left(left, lookup, "k", "key", ["name"], limit).collect()}
        assert got == {1: "first", 2: None, 3: None, 4: "first"}


def test_events_with_area_and_crashes(spark):
    events = spark.createDataFrame([(1, "10001-123", 40.7, -74.0), (2, " 11201 ", 40.6, -73.9), (3, "10302", None, None), (4, "99999", 1.0, 1.0)],
                                   "ID int, Zipcode string, Start_Lat double, Start_Lng double")
    lookup = spark.createDataFrame([("10001", "Manhattan"), ("10001", "Wrong")], "ZIP_Codes string, Borough string")
    rows = IN.events_with_area(events, lookup)
    assert {r["ID"]: r["Borough"] for r in rows.collect()} == {1: "Manhattan", 2: "Brooklyn", 3: "Staten Island"}
    crashes = spark.createDataFrame([(2016, 36, 1, 1, 40.701, -74.0)], "YEAR int, STATE int, ST_CASE int, VEH_NO int, FARS_LAT double, FARS_LON double")
    out = {r["ID"]: r for r in IN.events_with_crashes(rows, crashes).collect()}
    assert out[1]["FARS__ST_CASE"] == 1 and out[2]["FARS__ST_CASE"] is None and out[3]["match_distance_km"] is None


def test_materialize_and_report(spark, tmp_path):
    built = []

    def build():
        built.append(1)
        return spark.range(3)

    path = str(tmp_path / "slim")
    assert RD.materialize(spark, path, build).count() == 3 and RD.materialize(spark, path, build).count() == 3
    assert len(built) == 1
    assert len(SK.write_report({"a": spark.range(2), "b": None}, str(tmp_path / "rep"))) == 1
    with pytest.raises(KeyError):
        SK.write_target(spark.range(1), "absent", str(tmp_path), "test")


def test_processed_splits_and_selection(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.0, 3.0, 1)], "k int, b double, a double, y int")
    SK.write_processed_split(df, ["a", "b"], str(tmp_path), "train", "y", ["k"])
    SK.write_processed_split(df, ["a", "b"], str(tmp_path), "test", None, ["k"])
    SK.write_target(df, "y", str(tmp_path), "test", ["k"])
    assert spark.read.parquet(str(tmp_path / "test_processed")).columns == ["k", "a", "b"]
    chosen = spark.createDataFrame([("f2", 1), ("f1", 0)], "feature string, index int")
    SK.write_selection(chosen, chosen, str(tmp_path / "sel"))
    assert RD.read_csv(spark, str(tmp_path / "sel/feature_votes")).count() == 2
    assert SK.read_selection(spark, str(tmp_path / "sel")) == ["f1", "f2"]
    SK.write_attributions(df.select("k", "a"), 0.5, str(tmp_path / "phi"))
    assert spark.read.parquet(str(tmp_path / "phi/expected")).first()["expected_value"] == 0.5


def test_schema_enforcement(spark):
    df = spark.createDataFrame([("7", "a", "2024-01-01 00:00:00"), ("x", "q", "no")], "n string, c string, t string").withColumn("extra", F.lit(1))
    spec = [{"name": "c", "type": "string", "domain": ["a"]}, {"name": "n", "type": "bigint"}, {"name": "new", "type": "double"},
            {"name": "t", "type": "timestamp_ntz"}]
    out = C.enforce_schema(df, spec)
    assert out.columns == ["c", "n", "new", "t"]
    rows = out.collect()
    assert (rows[0]["c"], rows[0]["n"], rows[0]["new"]) == ("a", 7, None) and rows[0]["t"] is not None
    assert tuple(rows[1]) == (None, None, None, None)


def test_leak_guard_forms(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "Severity_bin int, my_severity int, Severity_x int, other int")
    assert C.leak_guard(df, "Severity_bin", ["severity"]).columns == ["Severity_bin", "other"]
    assert C.leak_guard(df, "Severity_bin", ["Severity"], prefix_only=True).columns == ["Severity_bin", "my_severity", "other"]


def test_median_category(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] * 3 + [("c",)] * 2 + [(None,)] * 9, "v string")
    assert median_category(df, "v") == "b"  # 3/8 after a, 6/8 after b
    assert fill_median_category(df, "v").filter("v = 'b'").count() == 12
    assert median_category(df.filter("v IS NULL"), "v") is None
    flat = spark.range(100).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("v"))
    assert median_category(flat, "v") == "049"


def test_tables(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None)], "k int, g string")
    assert {r["g"]: r["count"] for r in TB.frequency(df, "g").collect()} == {"a": 2, "b": 1, "Missing": 1}
    assert TB.overlaps(df, df.filter("k = 1"), ["k"]) and not TB.overlaps(df.filter("k = 1"), df.filter("k = 2"), ["k"])
    assert TB.best_row(df, "k") == {"k": 1, "g": "a"}
    with pytest.raises(ValueError):
        TB.levels_of(df, "g", limit=1)


def test_csv_reads_its_own_writer(spark, tmp_path):
    rows = [(1, 'he said "hi", ok\nnext'), (2, "back\\slash"), (3, None), (4, 'x"')]
    df = spark.createDataFrame(rows, "k int, t string")
    SK.write_csv(df, str(tmp_path / "own"))
    assert sorted(tuple(r) for r in RD.read_csv(spark, str(tmp_path / "own"), line_breaks=True).collect()) == rows


def test_lookup_prefers_a_value_over_null(spark):
    left = spark.createDataFrame([("a",), ("b",)], "k string")
    lookup = spark.createDataFrame([("a", None), ("a", "A"), ("b", None)], "k string, v string")
    assert sorted(tuple(r) for r in J.lookup_left(left, lookup, "k", "k", ["v"]).collect()) == [("a", "A"), ("b", None)]
