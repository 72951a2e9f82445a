"""Edge rows of the cleaning, binning and coding expressions."""

from pyspark.sql import functions as F

from tabloom.functions.numbers import key_hash
from tabloom.functions import numbers as N
from tabloom.functions import text as tx
from tabloom.plans import clean as CL
from tabloom.plans import features as FT


def values(spark, column, rows, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, v {kind}")
    return [r["o"] for r in df.select("i", column(F.col("v")).alias("o")).orderBy("i").collect()]


def test_postcode(spark):
    rows = ["10001-1234", " 11201 ", "123", None, "abc", "a1234567"]
    assert values(spark, tx.postcode, rows) == ["10001", "11201", None, None, None, "12345"]


def test_number_text(spark):
    rows = ["1", " 2.5 ", "1e3", "-.5", "1d", "NaN", "", None, "0x10", "1_000"]
    assert values(spark, N.number_from_text, rows) == [1.0, 2.5, 1000.0, -0.5] + [None] * 6


def test_dates(spark):
    rows = ["2016-02-08 00:37:08", "2016-02-08 00:37:08.123456789", "2016-​02-08  00:37:08", "00:00:00", "0", "", None,
            "２０１６-０２-０８ ００:３７:０８", "02/08/2016 05:06", "2016/2/8", "soon", "10:20", "2016-13-01", " 2016-02-08T01:02:03 "]
    got = [str(v) if v else None for v in values(spark, lambda c: tx.parse_date_text(tx.clean_date_text(c)), rows)]
    day = "2016-02-08 00:37:08"
    assert got == [day, day + ".123456", day, None, None, None, None, day, "2016-02-08 05:06:00", "2016-02-08 00:00:00",
                   None, None, None, "2016-02-08 01:02:03"]


def test_wind_and_weather(spark):
    assert values(spark, tx.wind_group, ["calm", "Variable", " nne ", "N/A", None, "q", "Sw"]) == [
        "OTHER", "OTHER", "NORTH", "MISSING", "MISSING", "OTHER", "WEST"]
    assert values(spark, tx.weather_group, ["T-Storm", "t-storm", "Rain / Windy", "unk", None, "MIST"]) == [
        "STORM", "STORM", "OTHER", "MISSING", "MISSING", "FOG"]


def test_highway(spark):
    rows = ["I-95 N", "i- 95", "Sunrise Hwy", "Broadway", None, "Cross Bronx", "ny route 27", "Highwayman St", "US-1"]
    assert values(spark, tx.matches_words, rows) == [True, True, True, False, False, True, True, False, True]


def test_cuts(spark):
    rows = [0.0, 0.134, 0.135, 0.757, 1.892, 9.0, 9.1, -1.0, None]
    short, medium, long = FT.DISTANCE_LABELS
    got = values(spark, lambda c: N.cut_or_first(c, [*FT.DISTANCE_EDGES, 9.0], FT.DISTANCE_LABELS), rows, "double")
    assert got == [short, short, short, short, medium, long, None, None, None]
    assert values(spark, lambda c: N.cut_or_first(c, [0.0, 0.757, 1.892, 1.892], FT.DISTANCE_LABELS), [5.0, None], "double") == [short, short]
    assert values(spark, lambda c: FT.rain_features(c)["Precipitation_cat"], [0.0, 0.1, 0.3, 1.0, 2.0, None], "float") == [
        "Dry", "Moderate", "Heavy", "Heavy", "Extreme", None]
    assert values(spark, lambda c: FT.rain_features(c)["Precipitation_cat"], [0.1, 0.3], "double") == ["Light", "Moderate"]


def test_codes(spark):
    ages = [0.0, 13.0, 14.0, 100.0, 101.0, 997.0, 998.0, 999.0, None]
    assert values(spark, CL.driver_age, ages, "double") == [None, None, 14.0, 100.0] + [None] * 5
    assert values(spark, tx.body_group, [1, 12, 17, 49, 97, 98, None], "int") == [
        "Passenger Car", "Missing", "Passenger Car", "Pickup/Light Truck", "Other Special Vehicle", "Missing", "Missing"]
    assert values(spark, lambda c: N.level_code(c, ["a", "b"]), ["b", "a", "z", None]) == [1, 0, -1, -1]
    assert values(spark, N.clip_low, [-1.0, 2.0, None], "double") == [0.0, 2.0, None]


def test_boolish_and_missing(spark):
    assert values(spark, tx.boolish_value, [" True", "0", "none", None]) == [1, 0, None, None]
    assert values(spark, tx.missing_level, [" x ", "NULL", "", None, "N/A"]) == ["x", "__MISSING__", "__MISSING__", "__MISSING__", "N/A"]


def test_date_parts(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-05 06:00:00' AS t UNION ALL SELECT TIMESTAMP_NTZ '2024-01-07 22:00:00' UNION ALL SELECT NULL")
    rows = df.select(*[c.alias(n) for n, c in tx.date_parts(F.col("t")).items()]).collect()
    assert [(r["Event_DOW"], r["Is_Weekend"], r["DayNight_3cat"]) for r in rows] == [
        (4.0, True, "Day"), (6.0, False, "Night"), (None, False, "Missing")]


def test_clean_pipeline(spark):
    rows = [(1, "CALM", "T-Storm", "I-95 N", 0.5, "3", "Day", 45, "K1", 2, 8.0), (2, None, None, None, None, "9", "x", None, None, 9, 999.0),
            (3, "N", "Fog", "A St", 0.1, "1", "Night", 1, "K1", 1, 0.0)]
    df = spark.createDataFrame(rows, "ID int, Wind_Direction string, Weather_Condition string, Street string, `Distance(mi)` double, "
                               "Severity string, Sunrise_Sunset string, FARS__BODY_TYP int, Airport_Code string, FARS__SEX int, FARS__ALC_RES double")
    out = {r["ID"]: r for r in CL.clean(CL.prepare(df), ("ID",)).collect()}
    assert [out[i]["Severity_2cat"] for i in (1, 2, 3)] == ["High (3–4)", "Missing", "Low (1–2)"]
    assert [out[i]["ALC_category"] for i in (1, 2, 3)] == ["Alcohol Present", "Missing", "No Alcohol"]
    assert [out[i]["FARS__SEX_label"] for i in (1, 2, 3)] == ["Female", "Missing", "Male"]
    assert [out[i]["Airport_Code"] for i in (1, 2, 3)] == ["K1", "K1", "K1"]
    assert [out[i]["Sunrise_Sunset"] for i in (1, 2, 3)] == [True, None, False]
    assert "FARS__ALC_RES" not in out[1].asDict() and "Street" not in out[1].asDict()
    assert CL.with_severity_bin(df).count() == 2


def test_usual_date_forms(spark):
    want = {"02/08/2016 05:46:00 PM": "2016-02-08 17:46:00", "02/08/2016 5:46 am": "2016-02-08 05:46:00", "2016-02-08T05:46:00Z": "2016-02-08 05:46:00",
            "2016-02-08 05:46:00+02:00": "2016-02-08 05:46:00", "Feb 8 2016": "2016-02-08 00:00:00", "february 8, 2016 17:46": "2016-02-08 17:46:00",
            "8 Feb 2016": "2016-02-08 00:00:00", "20160208": "2016-02-08 00:00:00", "2016/2/8": "2016-02-08 00:00:00", "19991399": None, "Foo 8 2016": None, "12": None}
    got = values(spark, lambda c: tx.parse_date_text(tx.clean_date_text(c)), list(want))
    assert [str(v) if v else None for v in got] == list(want.values())


def test_key_hashes_of_two_roles_are_independent(spark):
    df = spark.range(4000)
    a, b, c = (key_hash(df, ["id"], *x) for x in ((42, "a"), (42, "b"), (43, "a")))
    row = df.select(F.corr(a, b).alias("ab"), F.corr(a, c).alias("ac"), F.corr(a, F.col("id")).alias("ai"), F.avg(a).alias("m")).first()
    assert max(abs(row["ab"]), abs(row["ac"]), abs(row["ai"])) < 0.06 and abs(row["m"] / 2**31 - 1) < 0.05
