"""Prepare and clean: grouped columns, sentinel codes, type casts, target labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions import text as tx
from tabloom.functions.numbers import cut, null_codes, number, sign_bucket
from tabloom.operators.columns import q
from tabloom.operators.profile import fill_median_category

# Distance cut points in miles with their labels.
DISTANCE_EDGES = [float("-inf"), 0.134, 0.757, float("inf")]
DISTANCE_LABELS = ["≤0.13 mi (Short)", "0.13–0.76 mi (Medium)", ">0.76 mi (Long)"]
# Sentinel codes and limits.
AGE_CODES, AGE_LIMITS = [0, 997, 998, 999], (14, 100)
ALCOHOL_CODES = [995, 996, 997, 998, 999]
LOW_VISIBILITY = 3.0
# Columns that go before profiling, boolean columns, day/night columns.
DROP_COLUMNS = ["ID", "Street", "Zipcode", "City", "County", "State", "Country", "Timezone", "Turning_Loop",
                "Roundabout", "Zipcode_clean", "Zip_code_clean", "Bamp", "FARS__DRUGRES1", "FARS__DRUGRES2",
                "FARS__DRUGRES3", "FARS__FARS_LAT", "FARS__FARS_LON", "FARS__MONTH", "FARS__HOUR", "FARS__MINUTE",
                "FARS__STATE", "FARS__DAY", "FARS__YEAR", "Weather_Timestamp", "match_distance_km",
                "FARS__ST_CASE", "FARS__VEH_NO", "FARS__MOD_YEAR", "Wind_Direction", "Weather_Condition",
                "Description"]
BOOLEAN_COLUMNS = ["Amenity", "Bump", "Crossing", "Give_Way", "Junction", "No_Exit", "Railway", "Station", "Stop",
                   "Traffic_Calming", "Traffic_Signal", "Turning_Loop", "Street_is_highway", "Start_Time_isna",
                   "End_Time_isna", "Roundabout"]
TWILIGHT_COLUMNS = ["Sunrise_Sunset", "Civil_Twilight", "Nautical_Twilight", "Astronomical_Twilight"]


def prepare(df: DataFrame) -> DataFrame:
    """Highway flag, wind and weather groups and distance group, for the columns that are present."""
    added = {}
    if "Street" in df.columns:
        added["Street_is_highway"] = tx.matches_words(q("Street"))
    if "Wind_Direction" in df.columns:
        added["Wind_Direction_grp"] = tx.wind_group(q("Wind_Direction"))
    if "Weather_Condition" in df.columns:
        added["Weather_ConditionGroup"] = tx.weather_group(q("Weather_Condition"))
    if "Distance(mi)" in df.columns:
        added["Distance_group"] = cut(number(df, "Distance(mi)"), DISTANCE_EDGES, DISTANCE_LABELS)
    return df.withColumns(added) if added else df


def driver_age(c):
    return null_codes(c, AGE_CODES, *AGE_LIMITS).cast("float")


def severity_label(c):
    return (F.when(c.isin(1, 2), F.lit("Low (1–2)")).when(c.isin(3, 4), F.lit("High (3–4)"))
            .otherwise(F.lit("Missing")))


def severity_bin(c):
    return F.when(c.isin(1, 2), F.lit(0)).when(c.isin(3, 4), F.lit(1)).cast("tinyint")


def clean(df: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Sentinels to null, grouped codes, booleans, labels; ``keys`` survive the column drops."""
    out = df.drop(*[c for c in DROP_COLUMNS if c not in keys])
    added = {}
    if "FARS__DRIVER_AGE" in out.columns:
        added["FARS__DRIVER_AGE"] = driver_age(number(out, "FARS__DRIVER_AGE"))
    if "Visibility(mi)" in out.columns:
        v = number(out, "Visibility(mi)")
        added["Visibility_is_low"] = v <= LOW_VISIBILITY
        added["Visibility_2cat"] = sign_bucket(v, "Low", "Normal", "Missing", LOW_VISIBILITY)
    for c in BOOLEAN_COLUMNS:
        if c in out.columns:
            added[c] = q(c).try_cast("boolean")
    for c in TWILIGHT_COLUMNS:
        if c in out.columns:
            added[c] = tx.day_night_flag(q(c).cast("string"))
    if "FARS__BODY_TYP" in out.columns:
        added["FARS__BODY_TYP_Group"] = tx.body_group(number(out, "FARS__BODY_TYP"))
    if "FARS__SEX" in out.columns:
        sex = number(out, "FARS__SEX")
        code = F.when(sex.isin(1, 2), sex.cast("bigint")).otherwise(F.lit(3).cast("bigint"))
        added["FARS__SEX"] = F.when(sex.isin(1, 2), sex)
        added["FARS__SEX_3cat"] = code
        added["FARS__SEX_label"] = F.element_at(F.array(F.lit("Male"), F.lit("Female"), F.lit("Missing")),
                                                code.cast("int"))
    if "FARS__ALC_RES" in out.columns:
        added["ALC_category"] = sign_bucket(null_codes(number(out, "FARS__ALC_RES"), ALCOHOL_CODES),
                                            "No Alcohol", "Alcohol Present", "Missing")
    added["Severity_2cat"] = severity_label(number(out, "Severity"))
    out = out.withColumns(added).drop("FARS__ALC_RES")
    return fill_median_category(out, "Airport_Code") if "Airport_Code" in out.columns else out


def with_severity_bin(df: DataFrame) -> DataFrame:
    return df.withColumn("Severity_bin", severity_bin(number(df, "Severity"))).filter(F.col("Severity_bin").isNotNull())
