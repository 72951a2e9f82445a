"""Text, token, code-map and date cleaning as column expressions."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Tokens that count as missing, compared in lower case.
MISSING_TOKENS = ["", "na", "n/a", "null", "none", "missing", "unk", "unknown",
                  "<na>", "<nan>", "nan"]
# Spellings that become the missing level, compared as written.
MISSING_ALIASES = ["__MISSING__", "missing", "Missing", "MISSING", "na", "NA", "Na",
                   "none", "None", "NONE", "nan", "NaN", "NAN", "null", "Null", "NULL", ""]
MISSING_LEVEL = "__MISSING__"
# Tokens of a boolean-like text column and the share that makes it one.
BOOLISH_TOKENS = ["true", "false", "1", "0", "nan", "none"]
BOOLISH_SHARE = 0.9
# Three-digit postcode areas and their borough.
POSTCODE_AREAS = {"100": "Manhattan", "101": "Manhattan", "102": "Manhattan",
                  "103": "Staten Island", "104": "Bronx",
                  "111": "Queens", "112": "Brooklyn", "113": "Queens",
                  "114": "Queens", "116": "Queens"}
# Wind directions by group.
WIND_GROUPS = {
    "NORTH": ["N", "NNE", "NNW", "NORTH"],
    "EAST": ["E", "ENE", "ESE", "NE", "EAST"],
    "SOUTH": ["S", "SSE", "SE", "SSW", "SOUTH"],
    "WEST": ["W", "WNW", "WSW", "SW", "NW", "WEST"],
    "OTHER": ["VAR", "VARIABLE", "CALM"],
}
# Weather descriptions by group, in lower case.
WEATHER_GROUPS = {
    "CLEAR": ["fair", "clear", "mostly clear"],
    "CLOUDY": ["cloudy", "mostly cloudy", "overcast", "partly cloudy"],
    "RAIN": ["rain", "light rain", "showers", "drizzle", "heavy rain", "rain shower"],
    "SNOW": ["snow", "light snow", "sleet", "ice", "hail"],
    "FOG": ["fog", "mist", "haze", "smoke"],
    "STORM": ["thunderstorms", "t-storm", "storm", "heavy thunderstorms", "thunder"],
}
# Vehicle body codes by group.
BODY_GROUPS = {
    "Passenger Car": [1, 2, 3, 4, 5, 6, 7, 8, 9, 17],
    "SUV/CUV": [14, 15, 16, 19],
    "Van": [20, 21, 22, 28, 29, 41, 42, 48],
    "Pickup/Light Truck": [10, 11, 30, 31, 32, 33, 34, 39, 40, 45, 49],
    "Bus": [50, 51, 52, 55, 58, 59, 60],
    "Medium/Heavy Truck": [61, 62, 63, 64, 65, 66, 67, 71, 72, 73, 78, 79],
    "Motorcycle/3-Wheel": [80, 81, 82, 83, 84, 85, 86, 87],
    "Other Special Vehicle": [90, 91, 92, 93, 94, 95, 96, 97],
}
# Street words and road names that mark a highway.
HIGHWAY_PATTERN = (r"\b(?:EXPRESSWAY|EXPWY|EXPY|PARKWAY|PKWY|HIGHWAY|HWY)\b"
                   r"|\bI-\s*\d+\b|\bUS-\s*\d+\b|\bNY-\s*\d+\b"
                   r"|\bNY\s*ROUTE\s*\d+\b|\bROUTE\s*\d+\b")
HIGHWAY_NAMES = ["BQE", "BROOKLYN QUEENS EXPY", "LIE", "LONG ISLAND EXPY", "GCP",
                 "GRAND CENTRAL PKWY", "FDR", "FDR DR", "HARLEM RIVER DR", "CROSS BRONX",
                 "CROSS BRONX EXPY", "MAJOR DEEGAN", "DEEGAN", "VAN WYCK", "VAN WYCK EXPY",
                 "BELT PKWY", "BELT PARKWAY", "JACKIE ROBINSON PKWY", "INTERBORO PKWY",
                 "HENRY HUDSON PKWY", "WEST SIDE HWY", "CLEARVIEW EXPY", "BRONX RIVER PKWY",
                 "WHITESTONE EXPWY", "THROGS NECK EXPY", "SIE", "STATEN ISLAND EXPWY"]
# Text patterns of the date cleaner.
ZERO_WIDTH = "[\\u200B-\\u200D\\u2060\\uFEFF]"
CONTROL = "[\\x00-\\x1F\\x7F]"
ZERO_TIME = r"^(?:0{1,2}:?0{1,2}(?::?0{1,2})?|0+)$"
# Date forms accepted after cleaning; an ISO date may have a time with up to nine decimals.
SLASH_YEAR_FIRST = r"^(\d{4})/(\d{1,2})/(\d{1,2})(?=$|[ T])"
SLASH_YEAR_LAST = r"^(\d{1,2})/(\d{1,2})/(\d{4})(?=$|[ T])"
ZONE_END = r"^(\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d{1,9})?)?) ?(?:Z|UTC|GMT|[+-]\d{2}:?\d{2})$"
DIGITS_ONLY = r"^((?:19|20)\d{2})(\d{2})(\d{2})$"
CLOCK = r"\d{1,2}:\d{2}"
NAMED_FORMS = (
    (rf"(?i)^\d{{4}}-\d{{1,2}}-\d{{1,2}} {CLOCK}:\d{{2}} ?[AP]M$", "y-M-d h:m:s[ ]a"),
    (rf"(?i)^\d{{4}}-\d{{1,2}}-\d{{1,2}} {CLOCK} ?[AP]M$", "y-M-d h:m[ ]a"),
    (r"(?i)^[a-z]{3,9}\.? \d{1,2},? \d{4}$", "MMM d y"),
    (rf"(?i)^[a-z]{{3,9}}\.? \d{{1,2}},? \d{{4}} {CLOCK}:\d{{2}}$", "MMM d y H:m:s"),
    (rf"(?i)^[a-z]{{3,9}}\.? \d{{1,2}},? \d{{4}} {CLOCK}$", "MMM d y H:m"),
    (r"(?i)^\d{1,2} [a-z]{3,9}\.? \d{4}$", "d MMM y"),
)
ISO_START = r"^\d{4}-\d{1,2}-\d{1,2}(?:[ T]\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d{1,9})?)?)?$"


def strip(c: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def postcode(c: Column) -> Column:
    """First run of five digits, or null (``regexp_extract`` alone gives '')."""
    return F.lpad(F.nullif(F.regexp_extract(strip(c), r"(\d{5})", 1), F.lit("")), 5, "0")


def value_map(c: Column, mapping: Mapping) -> Column:
    """Look the value up in a small constant mapping; null if it is not there."""
    by_target: dict = {}
    for source, target in mapping.items():
        by_target.setdefault(target, []).append(source)
    return group_codes(c, by_target)


def group_codes(c: Column, groups: Mapping[str, Sequence], other: str | None = None) -> Column:
    """Label of the group that lists the value, ``other`` for the rest; null counts as the rest."""
    chain = None
    for label, members in groups.items():
        hit = c.isin(*members)
        chain = F.when(hit, F.lit(label)) if chain is None else chain.when(hit, F.lit(label))
    return chain.otherwise(F.lit(other)) if other is not None else chain


def is_missing_token(c: Column, tokens: Sequence[str] = tuple(MISSING_TOKENS)) -> Column:
    return c.isNull() | F.lower(strip(c)).isin(*tokens)


def grouped_text(c: Column, groups: Mapping[str, Sequence[str]], upper: bool,
                 other: str = "OTHER", missing: str = "MISSING") -> Column:
    """Group free text by a constant table; keys are compared in one letter case."""
    text = strip(c)
    folded = F.upper(text) if upper else F.lower(text)
    return F.when(is_missing_token(c), F.lit(missing)).otherwise(group_codes(folded, groups, other))


def wind_group(c: Column) -> Column:
    return grouped_text(c, WIND_GROUPS, upper=True)


def weather_group(c: Column) -> Column:
    return grouped_text(c, WEATHER_GROUPS, upper=False)


def body_group(c: Column) -> Column:
    return group_codes(c.cast("bigint"), BODY_GROUPS, "Missing")


def matches_words(c: Column, pattern: str = HIGHWAY_PATTERN,
                  names: Sequence[str] = tuple(HIGHWAY_NAMES)) -> Column:
    """True if upper-cased text meets the pattern or contains one of the names; null is false."""
    text = strip(F.upper(c))
    literal = "|".join(re.escape(n).replace("\\ ", " ") for n in names)
    hit = text.rlike(pattern)
    if names:
        hit = hit | text.rlike(literal)
    return F.coalesce(hit, F.lit(False))


def day_night_flag(c: Column) -> Column:
    text = strip(c)
    return F.when(text == "Day", F.lit(True)).when(text == "Night", F.lit(False))


def boolish_token(c: Column) -> Column:
    """Null text counts as a token, the way an absent value prints as one."""
    return F.coalesce(F.lower(strip(c)).isin(*BOOLISH_TOKENS), F.lit(True))


def boolish_value(c: Column) -> Column:
    text = F.lower(strip(c))
    return F.when(text.isin("true", "1"), F.lit(1)).when(text.isin("false", "0"), F.lit(0))


def missing_level(c: Column) -> Column:
    """Null and every missing alias become one level; other text is trimmed."""
    text = strip(c)
    return F.when(text.isNull() | text.isin(*MISSING_ALIASES), F.lit(MISSING_LEVEL)).otherwise(text)


def _fold(s: pd.Series) -> pd.Series:
    return s.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")


_nfkc = F.pandas_udf(_fold, T.StringType())


def clean_date_text(c: Column, fold_unicode: bool = True) -> Column:
    """Readable date text: no hidden or control characters, single blanks, zero times to null.

    Spark has no compatibility folding, so text with non-ASCII characters passes an
    Arrow UDF; plain ASCII text reaches it as null and costs nothing there.
    """
    text = F.regexp_replace(c, ZERO_WIDTH, "")
    text = F.regexp_replace(text, CONTROL, " ")
    if fold_unicode:
        exotic = F.when(text.rlike(r"[^\x00-\x7F]"), text)
        text = F.coalesce(_nfkc(exotic), text)
    text = F.regexp_replace(strip(text), r"\s+", " ")
    return F.when(~text.rlike(ZERO_TIME) & (text != ""), text)


def parse_date_text(c: Column) -> Column:
    """Timestamp without zone from the usual forms; other text is null.

    ISO, year/month/day and month/day/year are rewritten to ISO and take one cast; a trailing
    zone is dropped (the wall clock counts). Digits only, times with AM or PM and month names are
    tried where their pattern fits.
    """
    text = F.regexp_replace(c, ZONE_END, "$1")
    text = F.regexp_replace(text, SLASH_YEAR_FIRST, "$1-$2-$3")
    text = F.regexp_replace(text, SLASH_YEAR_LAST, "$3-$1-$2")
    text = F.regexp_replace(text, DIGITS_ONLY, "$1-$2-$3")
    parsed = F.regexp_extract(text, ISO_START, 0).try_cast("timestamp_ntz")
    for pattern, form in NAMED_FORMS:
        fits = F.when(text.rlike(pattern), F.regexp_replace(F.regexp_replace(text, ",", ""), r"(?i)\b(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.?", "$1"))
        parsed = F.coalesce(parsed, F.try_to_timestamp(F.initcap(fits) if "MMM" in form else F.upper(fits), F.lit(form)).cast("timestamp_ntz"))
    return parsed


def date_parts(ts: Column, prefix: str = "Event_", weekend: Sequence[int] = (4, 5),
               day_hours: tuple[int, int] = (6, 21)) -> dict[str, Column]:
    """Date, year, month, day, hour, weekday (Monday 0), weekend flag and day/night label."""
    hour, dow = F.hour(ts), F.weekday(ts)
    label = (F.when(ts.isNull(), F.lit("Missing"))
             .when(hour.between(*day_hours), F.lit("Day")).otherwise(F.lit("Night")))
    return {
        f"{prefix}Date": F.to_date(ts),
        f"{prefix}Year": F.year(ts).cast("bigint"),
        f"{prefix}Month": F.month(ts).cast("bigint"),
        f"{prefix}Day": F.dayofmonth(ts).cast("bigint"),
        f"{prefix}Hour": hour.cast("double"),
        f"{prefix}DOW": dow.cast("double"),
        "Is_Weekend": F.coalesce(dow.isin(*weekend), F.lit(False)),
        "DayNight_3cat": label,
    }
