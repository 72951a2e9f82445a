"""Load and integrate: events with an area by postcode, slim crash table, nearest crash per event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions import text as tx
from tabloom.functions.numbers import number
from tabloom.operators import columns as C
from tabloom.operators.joins import fill_from_map, inner_on, lookup_left
from tabloom.operators.neighbors import area_cap, nearest_capped

# State and county codes of the area, and the columns each crash table keeps.
STATE_CODE = 36
COUNTY_CODES = [5, 47, 61, 81, 85]
ACCIDENT_COLUMNS = ["YEAR", "STATE", "ST_CASE", "LATITUDE", "LATITUD", "LONGITUD", "LONGITUDE", "DEATHS"]
VEHICLE_COLUMNS = ["YEAR", "STATE", "ST_CASE", "VEH_NO", "MAKE", "MOD_YEAR", "BODY_TYP",
                   "VEH_DMAG_SCL_1", "VEH_DMAG_SCL_2"]
PERSON_COLUMNS = ["YEAR", "STATE", "ST_CASE", "VEH_NO", "AGE", "AGE_IM", "SEX", "DR_DRINK", "ALC_RES"]
SLIM_COLUMNS = ["YEAR", "STATE", "ST_CASE", "VEH_NO", "DRIVER_AGE", "SEX", "DR_DRINK", "ALC_RES", "MAKE",
                "MOD_YEAR", "BODY_TYP", "VEH_DMAG_SCL_1", "VEH_DMAG_SCL_2", "DEATHS", "FARS_LAT", "FARS_LON"]
MEMBER_PATTERNS = {"accident": r"ACCIDENT\.CSV$", "vehicle": r"VEHICLE\.CSV$", "person": r"PERSON\.CSV$"}
# Leading digits of the postcodes in the area.
POSTCODE_PREFIXES = ["100", "101", "102", "103", "104", "111", "112", "113", "114", "116"]


def events_with_area(events: DataFrame, lookup: DataFrame, postcode: str = "Zipcode",
                     lookup_code: str = "ZIP_Codes", area: str = "Borough",
                     prefixes: Sequence[str] = tuple(POSTCODE_PREFIXES)) -> DataFrame:
    """Rows of the postcode area with their borough: by lookup, else by postcode prefix."""
    rows = C.prefix_filter(events.withColumn("Zipcode_clean", tx.postcode(C.q(postcode).cast("string"))),
                           "Zipcode_clean", prefixes)
    codes = lookup.select(tx.postcode(C.q(lookup_code).cast("string")).alias("zip_code_clean"), C.q(area))
    codes = codes.withColumn("_code", F.col("zip_code_clean"))
    joined = lookup_left(rows, codes, "Zipcode_clean", "_code", ["zip_code_clean", area])
    return fill_from_map(joined, area, F.substring("Zipcode_clean", 1, 3), tx.POSTCODE_AREAS)


def slim_crashes(accident: DataFrame, vehicle: DataFrame, person: DataFrame, state: int = STATE_CODE,
                 counties: Sequence[int] = tuple(COUNTY_CODES)) -> DataFrame:
    """Driver rows with their vehicle and accident; case numbers repeat across years, so YEAR is a key."""
    case = [c for c in ("YEAR", "STATE", "ST_CASE") if all(c in t.columns for t in (accident, vehicle, person))]
    acc = C.area_filter(accident.filter(F.col("STATE") == state), "COUNTY", counties,
                        ["LATITUDE", "LATITUD"], ["LONGITUD", "LONGITUDE"])
    acc = C.rename_variants(C.keep_present(acc, ACCIDENT_COLUMNS),
                            {"FARS_LAT": ["LATITUDE", "LATITUD"], "FARS_LON": ["LONGITUD", "LONGITUDE"]})
    veh = C.keep_present(vehicle, VEHICLE_COLUMNS)
    per = C.filter_if_present(person.filter(F.col("STATE") == state), "PER_TYP", 1)
    per = C.rename_variants(C.keep_present(per, PERSON_COLUMNS), {"DRIVER_AGE": ["AGE", "AGE_IM"]})
    joined = inner_on(inner_on(per, veh, [*case, "VEH_NO"]), acc, case)
    keys = {*case, "VEH_NO"}
    numeric = {c: number(joined, c) for c in SLIM_COLUMNS if c in joined.columns and c not in keys}
    return C.keep_present(joined.withColumns(numeric), SLIM_COLUMNS).distinct()


def events_with_crashes(events: DataFrame, crashes: DataFrame, area: str = "Borough",
                        left_xy: tuple[str, str] = ("Start_Lat", "Start_Lng"),
                        right_xy: tuple[str, str] = ("FARS_LAT", "FARS_LON")) -> DataFrame:
    keys = [c for c in ("YEAR", "STATE", "ST_CASE", "VEH_NO") if c in crashes.columns]
    cap = area_cap(C.q(area)) if area in events.columns else area_cap(F.lit(None).cast("string"))
    return nearest_capped(events, crashes, left_xy, right_xy, keys, cap)
