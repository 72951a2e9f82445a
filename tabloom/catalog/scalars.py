"""Cleaning, binning and coding of single columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.catalog.base import miss, miss_sql, query
from tabloom.functions import numbers as N
from tabloom.functions import text as tx
from tabloom.operators.ranks import cut_or_quantiles
from tabloom.operators.sentiment import lexicon_sentiment
from tabloom.operators.tables import class_sentiment_summary
from tabloom.plans import clean as CL
from tabloom.plans import features as FT
from tabloom.session import small_table


def pick(key: str, values: list):
    """Value by key modulo the list length; None stays null."""
    chain = F.when(F.col(key) % len(values) == 0, F.lit(values[0]))
    for i, v in enumerate(values[1:], 1):
        chain = chain.when(F.col(key) % len(values) == i, F.lit(v))
    return chain


def pick_sql(key: str, values: list) -> str:
    arms = " ".join(f"WHEN {i} THEN " + ("NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v))
                    for i, v in enumerate(values))
    return f"CASE {key} % {len(values)} {arms} END"


@query("zip_clean", """
SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN lpad(CAST(o_custkey AS VARCHAR), 5, '0')
       WHEN 1 THEN lpad(CAST(o_custkey AS VARCHAR), 5, '7') END AS zip FROM orders""")
def zip_clean(read):
    code = F.col("o_custkey").cast("string")
    raw = (F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lpad(code, 5, "0"), F.lit("-1234")))
           .when(F.col("o_orderkey") % 5 == 1, F.concat(F.lit(" "), F.lpad(code, 5, "7"), F.lit("\t")))
           .when(F.col("o_orderkey") % 5 == 2, F.substring(code, 1, 4)).when(F.col("o_orderkey") % 5 == 3, F.lit("abc")))
    return read("orders").select("o_orderkey", tx.postcode(raw).alias("zip"))


STREETS = ["I-95 N", "old hwy 9", "Belt Pkwy E", None, "NY Route 27", "Sunrise Blvd", "Cross Bronx", "Highways Ave", "us- 1"]


@query("highway_flag", f"""
SELECT p_partkey, p_partkey % 9 IN (0, 1, 2, 4, 6, 8) AS highway FROM part""")
def highway_flag(read):
    street = F.concat_ws(" ", pick("p_partkey", STREETS))
    street = F.when(F.col("p_partkey") % 9 != 3, street)
    return read("part").select("p_partkey", tx.matches_words(street).alias("highway"))


@query("missing_tokens", f"""
SELECT p_partkey, p_partkey % 7 IN (0, 1, 2, 4, 6) AS missing,
       CASE WHEN p_partkey % 7 IN (0, 1, 2, 4, 6) THEN 'Missing' ELSE p_type END AS label FROM part""")
def missing_tokens(read):
    raw = F.coalesce(pick("p_partkey", [" N/A", "unknown", "", None, "<NA>", None, "  "]),
                     F.when((F.col("p_partkey") % 7).isin(3, 5), F.col("p_type")))
    gone = tx.is_missing_token(raw)
    return read("part").select("p_partkey", gone.alias("missing"), F.when(gone, "Missing").otherwise(raw).alias("label"))


WIND = ["calm", "Variable", " nne ", "N/A", None, "WSW", "xyz", "se", "East"]
WIND_OUT = ["OTHER", "OTHER", "NORTH", "MISSING", "MISSING", "WEST", "OTHER", "SOUTH", "EAST"]
SKY = ["T-Storm", "t-storm", "Rain / Windy", "Mostly Cloudy", "haze ", "unk", None, "Light Snow", "Drizzle", "FAIR"]
SKY_OUT = ["STORM", "STORM", "OTHER", "CLOUDY", "FOG", "MISSING", "MISSING", "SNOW", "RAIN", "CLEAR"]
BODIES = "CASE " + " ".join(f"WHEN p_size IN ({', '.join(map(str, codes))}) THEN '{label}'"
                            for label, codes in tx.BODY_GROUPS.items()) + " ELSE 'Missing' END"


@query("map_groups", f"""
SELECT p_partkey, {pick_sql('p_partkey', WIND_OUT)} AS wind, {pick_sql('p_partkey', SKY_OUT)} AS sky,
       {BODIES} AS body, CASE p_partkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS day FROM part""")
def map_groups(read):
    return read("part").select(
        "p_partkey", tx.wind_group(pick("p_partkey", WIND)).alias("wind"), tx.weather_group(pick("p_partkey", SKY)).alias("sky"),
        tx.body_group(F.col("p_size")).alias("body"),
        tx.day_night_flag(pick("p_partkey", [" Day", "Night ", "dusk"])).alias("day"))


@query("fixed_cut", """
SELECT band, count(*) AS n, round(sum(v), 2) AS total FROM (
SELECT v, CASE WHEN v <= 0.134::DOUBLE THEN '≤0.13 mi (Short)' WHEN v <= 0.757::DOUBLE THEN '0.13–0.76 mi (Medium)'
          ELSE '>0.76 mi (Long)' END AS band FROM (SELECT l_discount * 10 AS v FROM lineitem)) GROUP BY band""")
def fixed_cut(read):
    v = F.col("l_discount") * 10
    return (read("lineitem").select(v.alias("v"), N.cut(v, CL.DISTANCE_EDGES, CL.DISTANCE_LABELS).alias("band"))
            .groupBy("band").agg(F.count("*").alias("n"), F.round(F.sum("v"), 2).alias("total")))


@query("quantile_cut", """
SELECT l_orderkey, l_linenumber, l_extendedprice,
       CASE WHEN l_extendedprice <= q2 THEN 'low' WHEN l_extendedprice <= q3 THEN 'mid' ELSE 'high' END AS band
FROM lineitem, (SELECT quantile_cont(l_extendedprice, 0.5) AS q2, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem)""")
def quantile_cut(read):
    rows = read("lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return cut_or_quantiles(rows, "l_extendedprice", [0.0, 1e6, 2e6, rows.agg(F.max("l_extendedprice")).first()[0]], ["low", "mid", "high"], "band")


@query("sex_codes", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber IN (1, 2) AND l_orderkey % 7 <> 0 THEN l_linenumber END::DOUBLE AS FARS__SEX,
    CASE WHEN l_linenumber IN (1, 2) AND l_orderkey % 7 <> 0 THEN l_linenumber ELSE 3 END::BIGINT AS FARS__SEX_3cat,
    CASE WHEN l_orderkey % 7 = 0 THEN 'Missing' WHEN l_linenumber = 1 THEN 'Male' WHEN l_linenumber = 2 THEN 'Female' ELSE 'Missing' END AS FARS__SEX_label FROM lineitem""")
def sex_codes(read):
    """Code and label of 1 and 2; every other code and a missing one are the third class."""
    rows = read("lineitem").select("l_orderkey", "l_linenumber", miss("l_orderkey", "l_linenumber").cast("double").alias("FARS__SEX"), F.lit(2).alias("Severity"))
    return CL.clean(rows).select("l_orderkey", "l_linenumber", "FARS__SEX", "FARS__SEX_3cat", "FARS__SEX_label")


@query("float32_cut", """
SELECT rain_cat, count(*) AS n, round(sum(rain_log), 4) AS total, band, count(band) AS banded FROM (
SELECT CASE WHEN f < -1e-12 THEN NULL WHEN f <= 0 THEN 'Dry' WHEN f <= 0.1::DOUBLE THEN 'Light'
            WHEN f <= 0.3::DOUBLE THEN 'Moderate' WHEN f <= 1.0 THEN 'Heavy' ELSE 'Extreme' END AS rain_cat,
       CAST(ln(1 + f) AS FLOAT)::DOUBLE AS rain_log,
       CASE WHEN v < 0 THEN NULL WHEN v <= 0.757::DOUBLE THEN 'Short' WHEN v <= 1.892::DOUBLE THEN 'Medium'
            WHEN v <= 2.5 THEN 'Long' END AS band
FROM (SELECT CAST(greatest(l_discount * l_linenumber - 0.02::DOUBLE, 0) AS FLOAT)::DOUBLE AS f,
             l_quantity / 16 - 0.5::DOUBLE AS v FROM lineitem)) GROUP BY rain_cat, band""")
def float32_cut(read):
    rain = N.clip_low(F.col("l_discount") * F.col("l_linenumber") - 0.02).cast("float")
    parts = FT.rain_features(rain)
    v = F.col("l_quantity") / 16 - 0.5
    band = N.cut_or_first(v, [*FT.DISTANCE_EDGES, 2.5], FT.DISTANCE_LABELS)
    return (read("lineitem").select(parts["Precipitation_cat"].alias("rain_cat"), parts["Precipitation_log"].alias("rain_log"),
                                    band.alias("band"))
            .groupBy("rain_cat", "band").agg(F.count("*").alias("n"), F.round(F.sum(F.col("rain_log").cast("double")), 4).alias("total"),
                                             F.count("band").alias("banded")))


DIRTY = """SELECT event_id, CASE WHEN event_id % 6 = 3 THEN NULL WHEN event_id % 6 = 2 THEN date_trunc('second', ts) + INTERVAL 123456 MICROSECOND
           WHEN event_id % 6 = 5 THEN date_trunc('day', ts) ELSE date_trunc('second', ts) END AS t FROM events"""


@query("datetime_clean_parts", f"""
SELECT event_id, epoch_us(t) AS micros, CAST(year(t) AS BIGINT) AS "Event_Year", CAST(month(t) AS BIGINT) AS "Event_Month",
CAST(day(t) AS BIGINT) AS "Event_Day", CAST(hour(t) AS DOUBLE) AS "Event_Hour", CAST(isodow(t) - 1 AS DOUBLE) AS "Event_DOW",
coalesce(isodow(t) IN (5, 6), false) AS "Is_Weekend",
CASE WHEN t IS NULL THEN 'Missing' WHEN hour(t) BETWEEN 6 AND 21 THEN 'Day' ELSE 'Night' END AS "DayNight_3cat"
FROM ({DIRTY})""")
def datetime_clean_parts(read):
    plain = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    k = F.col("event_id") % 6
    wide = F.translate(plain, "0123456789", "".join(chr(0xFF10 + i) for i in range(10)))
    dirty = (F.when(k == 0, plain).when(k == 1, F.concat(F.lit("​ "), F.regexp_replace(plain, " ", " \t "), F.lit("\x07")))
             .when(k == 2, F.concat(plain, F.lit(".123456789"))).when(k == 3, F.lit(" 00:00:00 ")).when(k == 4, wide)
             .otherwise(F.date_format("ts", "MM/dd/yyyy")))
    rows = read("events").select("event_id", tx.parse_date_text(tx.clean_date_text(dirty)).alias("start"))
    t = F.coalesce(F.col("start"), F.lit(None).cast("timestamp_ntz"))
    parts = {k: v for k, v in tx.date_parts(t).items() if k != "Event_Date"}
    return rows.select("event_id", F.unix_micros(t.cast("timestamp")).alias("micros"), *[c.alias(n) for n, c in parts.items()])


@query("ordered_codes", """
SELECT o_orderkey, CAST(CASE o_orderpriority WHEN '5-LOW' THEN 0 WHEN '3-MEDIUM' THEN 1 WHEN '1-URGENT' THEN 2 ELSE -1 END AS SMALLINT) AS code,
       CAST(CASE WHEN o_orderkey % 7 = 0 THEN -1 WHEN o_orderstatus = 'F' THEN 0 WHEN o_orderstatus = 'O' THEN 1 ELSE 2 END AS SMALLINT) AS status
FROM orders""")
def ordered_codes(read):
    return read("orders").select(
        "o_orderkey", N.level_code(F.col("o_orderpriority"), ["5-LOW", "3-MEDIUM", "1-URGENT"]).alias("code"),
        N.level_code(miss("o_orderkey", "o_orderstatus"), ["F", "O", "P"]).alias("status"))


AGES = [0, 13, 14, 100, 101, 997, 998, 999, None, 33]
AGES_OUT = [None, None, 14, 100, None, None, None, None, None, 33]
ALCOHOL = [0, -1, 8, 995, 999, None]
ALCOHOL_OUT = ["No Alcohol", "No Alcohol", "Alcohol Present", "Missing", "Missing", "Missing"]


@query("sentinel_null", f"""
SELECT p_partkey, CAST({pick_sql('p_partkey', AGES_OUT)} AS DOUBLE) AS age, {pick_sql('p_partkey', ALCOHOL_OUT)} AS alcohol,
       CASE WHEN p_partkey % 7 <> 0 THEN p_size <= 3 END AS low,
       CASE WHEN p_partkey % 7 = 0 THEN 'Missing' WHEN p_size <= 3 THEN 'Low' ELSE 'Normal' END AS visibility,
       {pick_sql('p_partkey', [True, False, None])} AS flag FROM part""")
def sentinel_null(read):
    size = miss("p_partkey", "p_size").cast("double")
    return read("part").select(
        "p_partkey", CL.driver_age(pick("p_partkey", AGES)).cast("double").alias("age"),
        N.sign_bucket(N.null_codes(pick("p_partkey", ALCOHOL), CL.ALCOHOL_CODES), "No Alcohol", "Alcohol Present", "Missing").alias("alcohol"),
        (size <= 3.0).alias("low"), N.sign_bucket(size, "Low", "Normal", "Missing", 3.0).alias("visibility"),
        pick("p_partkey", ["true", "False", "maybe"]).try_cast("boolean").alias("flag"))


@query("two_level", """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'Missing' WHEN o_orderkey % 5 <= 2 THEN 'Low (1–2)' ELSE 'High (3–4)' END AS label,
       CAST(CASE WHEN o_orderkey % 5 <= 2 THEN 0 ELSE 1 END AS TINYINT) AS bin FROM orders WHERE o_orderkey % 5 <> 0""")
def two_level(read):
    rows = read("orders").select("o_orderkey", (F.col("o_orderkey") % 5).cast("double").alias("Severity"))
    rows = CL.with_severity_bin(rows)
    return rows.select("o_orderkey", CL.severity_label(F.col("Severity")).alias("label"), F.col("Severity_bin").alias("bin"))


@query("boolish_missing", f"""
SELECT event_id, {pick_sql('event_id', [1, 0, None, 0])} AS flag,
       CASE WHEN event_id % 5 IN (0, 1, 2) THEN '__MISSING__' WHEN event_id % 5 = 3 THEN event_type ELSE 'N/A' END AS word,
       true AS boolish FROM events""")
def boolish_missing(read):
    raw = pick("event_id", [" TRUE ", "false", "nan", "0"])
    word = F.coalesce(pick("event_id", ["NULL", "", None, None, "N/A"]), F.when(F.col("event_id") % 5 == 3, F.col("event_type")))
    rows = read("events").select("event_id", raw.alias("raw"), word.alias("word"))
    share = rows.agg(F.avg(tx.boolish_token(F.col("raw")).cast("double"))).first()[0]
    return rows.select("event_id", tx.boolish_value(F.col("raw")).alias("flag"), tx.missing_level(F.col("word")).alias("word"),
                       F.lit(share >= tx.BOOLISH_SHARE).alias("boolish"))


LEXICON = [("this", 0.25, 0.5), ("thing", 0.75, 0.5), ("nicht", -0.5, 0.75), ("from", -0.125, 0.25), ("pour", 0.5, 1.0), ("than", -0.25, 0.125)]
LEXICON_SQL = ", ".join(f"('{t}', {p}::DOUBLE, {s}::DOUBLE)" for t, p, s in LEXICON)
SENTIMENT_SQL = f"""
SELECT doc_id, polarity, subjectivity, CAST(sign(polarity) AS TINYINT) AS sentiment FROM (
SELECT d.doc_id, coalesce(avg(l.p), 0) AS polarity, coalesce(avg(l.s), 0) AS subjectivity
FROM documents d LEFT JOIN (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS token FROM documents) w USING (doc_id)
LEFT JOIN (VALUES {LEXICON_SQL}) l(token, p, s) ON w.token = l.token GROUP BY d.doc_id)"""


def _sentiment(read, keep=()):
    docs = read("documents")
    lexicon = small_table(docs.sparkSession, LEXICON, "token string, polarity double, subjectivity double")
    return lexicon_sentiment(docs, "text", ["doc_id"], lexicon, keep)


@query("lexicon_sentiment", f"SELECT doc_id, round(polarity, 8) AS polarity, round(subjectivity, 8) AS subjectivity, sentiment FROM ({SENTIMENT_SQL})")
def lexicon_sentiment_query(read):
    return _sentiment(read).withColumns({c: F.round(c, 8) for c in ("polarity", "subjectivity")})


@query("class_pivot_summary", f"""
SELECT quality, count(*) AS n_rows, round(avg(polarity), 6) AS mean_polarity, round(avg(subjectivity), 6) AS mean_subjectivity,
""" + ", ".join(f"count(*) FILTER (sentiment = {v}) AS {n}_count, round(count(*) FILTER (sentiment = {v}) * 100.0::DOUBLE / count(*), 2) AS {n}_pct"
                for v, n in ((-1, "neg"), (0, "neu"), (1, "pos"))) + f"""
FROM ({SENTIMENT_SQL}) JOIN labels USING (doc_id) GROUP BY quality""")
def class_pivot_summary(read):
    joined = _sentiment(read).join(read("labels").select("doc_id", "quality"), "doc_id")
    return class_sentiment_summary(joined, "quality").withColumns(
        {c: F.round(c, 6) for c in ("mean_polarity", "mean_subjectivity")})


@query("log_clip", f"""
SELECT l_returnflag, round(sum(ln(1 + coalesce(greatest(v, 0), 0))), 4) AS total, count(v) AS n FROM (
SELECT l_returnflag, {miss_sql('l_orderkey', 'l_quantity - 10')} AS v FROM lineitem) GROUP BY 1""")
def log_clip(read):
    v = F.when(F.col("l_orderkey") % 7 != 0, F.col("l_quantity") - 10)
    rows = read("lineitem").select("l_returnflag", N.clip_low(v).alias("v"))
    return rows.groupBy("l_returnflag").agg(F.round(F.sum(F.log1p(F.coalesce("v", F.lit(0.0)))), 4).alias("total"), F.count("v").alias("n"))
