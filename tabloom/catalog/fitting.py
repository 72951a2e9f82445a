"""Splits, imputers, encoders and the fit/apply pipeline."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.catalog.base import hash_sql, miss, miss_sql, query
from tabloom.functions import text as tx
from tabloom.operators.encode import Preprocessor, standardize
from tabloom.operators.impute import ChainedImputer, GroupDrawImputer, KnnImputer, MedianImputer
from tabloom.operators.levels import fit_levels, level_codes, one_hot
from tabloom.operators.split import folds, stratified_split
from tabloom.plans.features import FeatureConfig, FeatureModel, fit_features
from tabloom.session import scratch_path


def _quota_sql(source: str, draws: str, out: str) -> str:
    """Class quotas by largest remainder over a table (c, n)."""
    return f"""(SELECT c, n, total, CAST(f + CASE WHEN row_number() OVER (ORDER BY e - f DESC, c) <= {draws} - sum(f) OVER () THEN 1 ELSE 0 END AS BIGINT) AS {out}
FROM (SELECT c, n, total, (n * {draws})::DOUBLE / total AS e, floor((n * {draws})::DOUBLE / total) AS f
FROM (SELECT *, CAST(sum(n) OVER () AS BIGINT) AS total FROM {source})))"""


SPLIT_SQL = f"""
WITH counts AS (SELECT o_orderstatus AS c, count(*) AS n FROM orders GROUP BY 1),
rest AS (SELECT c, n, q AS n2 FROM {_quota_sql('counts', '(total - CAST(ceil(0.15::DOUBLE * total) AS BIGINT))', 'q')}),
kept AS (SELECT c, q FROM {_quota_sql('(SELECT c, n2 AS n FROM rest)',
         '(total - CAST(ceil(0.15::DOUBLE / (0.7::DOUBLE + 0.15::DOUBLE) * total) AS BIGINT))', 'q')}),
placed AS (SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY {hash_sql('o_orderkey', 42, 'split')}, o_orderkey) AS rn FROM orders)
SELECT o_orderkey, o_orderstatus, CASE WHEN rn <= n - n2 THEN 'test' WHEN rn <= n - q THEN 'val' ELSE 'train' END AS split
FROM placed JOIN rest ON rest.c = o_orderstatus JOIN kept ON kept.c = o_orderstatus"""


@query("stratified_split", SPLIT_SQL)
def stratified_split_query(read):
    return stratified_split(read("orders").select("o_orderkey", "o_orderstatus"), ["o_orderkey"], "o_orderstatus")


@query("split_sizes", f"SELECT split, o_orderstatus, count(*) AS n FROM ({SPLIT_SQL}) GROUP BY 1, 2")
def split_sizes(read):
    rows = stratified_split(read("orders").select("o_orderkey", "o_orderstatus"), ["o_orderkey"], "o_orderstatus")
    return rows.groupBy("split", "o_orderstatus").agg(F.count("*").alias("n"))


def _exact_quota_sql(source: str, draws: str, out: str) -> str:
    """Class quotas by largest remainder in whole numbers over a table (c, n)."""
    return f"""(SELECT c, n, total, f + CASE WHEN row_number() OVER (ORDER BY r DESC, CAST(c AS VARCHAR)) <= {draws} - sum(f) OVER () THEN 1 ELSE 0 END AS {out}
FROM (SELECT c, n, total, (n * {draws}) % total AS r, (n * {draws}) // total AS f FROM (SELECT *, CAST(sum(n) OVER () AS BIGINT) AS total FROM {source})))"""


@query("split_per_customer", f"""
WITH counts AS (SELECT o_custkey AS c, count(*) AS n FROM orders GROUP BY 1),
rest AS (SELECT c, n, CAST(q AS BIGINT) AS n2 FROM {_exact_quota_sql('counts', '(total - CAST(ceil(0.15::DOUBLE * total) AS BIGINT))', 'q')}),
kept AS (SELECT c, q FROM {_exact_quota_sql('(SELECT c, n2 AS n FROM rest)',
         '(total - CAST(ceil(0.15::DOUBLE / (0.7::DOUBLE + 0.15::DOUBLE) * total) AS BIGINT))', 'q')}),
placed AS (SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY {hash_sql('o_orderkey', 42, 'split')}, o_orderkey) AS rn FROM orders)
SELECT o_orderkey, o_custkey, CASE WHEN rn <= n - n2 THEN 'test' WHEN rn <= n - q THEN 'val' ELSE 'train' END AS split
FROM placed JOIN rest ON rest.c = o_custkey JOIN kept ON kept.c = o_custkey""")
def split_per_customer(read):
    """A class per customer: as many classes as the table has, quotas and cut points as tables."""
    return stratified_split(read("orders").select("o_orderkey", "o_custkey"), ["o_orderkey"], "o_custkey", min_per_class=1)


@query("kfold_assign", f"""
SELECT event_id, CAST(CASE WHEN rn <= n // 3 + CASE WHEN n % 3 > 0 THEN 1 ELSE 0 END THEN 0
  WHEN rn <= 2 * (n // 3) + least(n % 3, 2) THEN 1 ELSE 2 END AS INTEGER) AS fold
FROM (SELECT event_id, row_number() OVER (ORDER BY {hash_sql('event_id', 42, 'fold')}, event_id) AS rn, count(*) OVER () AS n FROM events)""")
def kfold_assign(read):
    return folds(read("events").select("event_id"), ["event_id"])


GAPPED = """SELECT event_id, CAST(day(ts) AS BIGINT) AS day, event_type,
CASE WHEN event_id % 7 <> 0 AND NOT (event_type = 'signup' AND day(ts) = 3) THEN value END AS value FROM events"""


@query("random_group_impute", f"""
WITH e AS ({GAPPED}),
g AS (SELECT day, event_type, value, row_number() OVER (PARTITION BY day, event_type ORDER BY value) - 1 AS pos,
      count(*) OVER (PARTITION BY day, event_type) AS n FROM e WHERE value IS NOT NULL),
a AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS pos, count(*) OVER () AS n FROM e WHERE value IS NOT NULL),
s AS (SELECT day, event_type, max(n) AS n FROM g GROUP BY 1, 2),
w AS (SELECT e.event_id, e.day, e.event_type, s.n, {hash_sql('event_id', 42, 'value')} AS h FROM e LEFT JOIN s USING (day, event_type) WHERE e.value IS NULL)
SELECT event_id, value FROM e WHERE value IS NOT NULL
UNION ALL SELECT w.event_id, g.value FROM w JOIN g USING (day, event_type) WHERE g.pos = w.h % w.n
UNION ALL SELECT w.event_id, a.value FROM w JOIN a ON a.pos = w.h % a.n WHERE w.n IS NULL""")
def random_group_impute(read):
    known = (F.col("event_id") % 7 != 0) & ~((F.col("event_type") == "signup") & (F.dayofmonth("ts") == 3))
    rows = read("events").select("event_id", F.dayofmonth("ts").cast("bigint").alias("day"), "event_type",
                                 F.when(known, F.col("value")).alias("value"))
    model = GroupDrawImputer(["value"], ["day", "event_type"], ["event_id"]).fit(rows)
    return model.transform(rows).select("event_id", "value")


@query("median_fill", f"""
SELECT o_orderkey, round(coalesce({miss_sql('o_orderkey', 'o_totalprice')},
  (SELECT median({miss_sql('o_orderkey', 'o_totalprice')}) FROM orders)), 4) AS price FROM orders""")
def median_fill(read):
    rows = read("orders").select("o_orderkey", miss("o_orderkey", "o_totalprice").alias("price"))
    return MedianImputer(["price"]).fit(rows).transform(rows).withColumn("price", F.round("price", 4))


KNN_COLS = ["size", "price", "brand"]
KNN_SQL = f"""
WITH p AS (SELECT p_partkey, {miss_sql('p_partkey', 'p_size')}::DOUBLE AS size, {miss_sql('p_partkey', '(p_retailprice - 900)', 5)} AS price,
           {miss_sql('p_partkey', "CAST(substring(p_brand, 7) AS INTEGER)", 11)}::DOUBLE AS brand FROM part),
t AS (SELECT size, price, brand, count(*) AS n FROM p GROUP BY 1, 2, 3),
r AS (SELECT DISTINCT size, price, brand FROM p WHERE size IS NULL OR price IS NULL OR brand IS NULL),
""" + ",\n".join(f"""d_{c} AS (SELECT r.size, r.price, r.brand, t.{c} AS v, t.n,
  (coalesce((r.size - t.size) * (r.size - t.size), 0) + coalesce((r.price - t.price) * (r.price - t.price), 0)
   + coalesce((r.brand - t.brand) * (r.brand - t.brand), 0))
  * (3.0::DOUBLE / ((r.size IS NOT NULL AND t.size IS NOT NULL)::INT + (r.price IS NOT NULL AND t.price IS NOT NULL)::INT
                    + (r.brand IS NOT NULL AND t.brand IS NOT NULL)::INT)) AS d2
  FROM r JOIN t ON r.{c} IS NULL AND t.{c} IS NOT NULL
  WHERE (r.size IS NOT NULL AND t.size IS NOT NULL) OR (r.price IS NOT NULL AND t.price IS NOT NULL) OR (r.brand IS NOT NULL AND t.brand IS NOT NULL)),
k_{c} AS (SELECT *, least(n, 5 - before) AS m FROM (
  SELECT *, coalesce(sum(n) OVER (PARTITION BY size, price, brand ORDER BY d2, v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d_{c}) WHERE before < 5),
f_{c} AS (SELECT size, price, brand, coalesce(sum(m * v) FILTER (d2 = 0) / sum(m) FILTER (d2 = 0),
  sum(m * v / sqrt(d2)) FILTER (d2 > 0) / sum(m / sqrt(d2)) FILTER (d2 > 0)) AS fill FROM k_{c} GROUP BY 1, 2, 3)""" for c in KNN_COLS) + """
SELECT p.p_partkey, """ + ", ".join(f"round(coalesce(p.{c}, f_{c}.fill, (SELECT avg({c}) FROM p)), 6) AS {c}" for c in KNN_COLS) + """
FROM p """ + " ".join(f"""LEFT JOIN f_{c} ON p.{c} IS NULL AND p.size IS NOT DISTINCT FROM f_{c}.size
AND p.price IS NOT DISTINCT FROM f_{c}.price AND p.brand IS NOT DISTINCT FROM f_{c}.brand""" for c in KNN_COLS)


def _parts(read):
    return read("part").select(
        "p_partkey", miss("p_partkey", "p_size").cast("double").alias("size"),
        F.when(F.col("p_partkey") % 5 != 0, F.col("p_retailprice") - 900).alias("price"),
        F.when(F.col("p_partkey") % 11 != 0, F.substring("p_brand", 7, 4).cast("int")).cast("double").alias("brand"))


@query("knn_impute", KNN_SQL)
def knn_impute(read):
    rows = _parts(read)
    return KnnImputer(KNN_COLS).fit(rows).transform(rows).withColumns({c: F.round(c, 6) for c in KNN_COLS})


def _chain_rows(read):
    return read("lineitem").select(
        "l_orderkey", "l_linenumber", miss("l_orderkey", "l_quantity").alias("quantity"),
        F.when(F.col("l_partkey") % 5 != 0, F.col("l_extendedprice") / 100 + F.col("l_quantity")).alias("price"),
        F.when(F.col("l_suppkey") % 3 != 0, F.col("l_tax") * 100 + F.col("l_quantity") / 2).alias("tax"),
        F.col("l_discount").alias("discount"))


@query("mice_impute")
def mice_impute(read):
    rows = _chain_rows(read)
    return ChainedImputer(["quantity", "price", "tax", "discount"]).fit(rows).transform(rows)


@query("mice_facts", f"""
SELECT count(*) AS "rows", CAST(0 AS BIGINT) AS nulls_left, round(sum({miss_sql('l_orderkey', 'l_quantity')}), 2) AS observed_quantity,
  round(sum(CASE WHEN l_suppkey % 3 <> 0 THEN l_tax * 100 + l_quantity / 2 END), 2) AS observed_tax,
  count(*) FILTER (l_suppkey % 3 = 0) AS filled_tax, true AS in_reach FROM lineitem""")
def mice_facts(read):
    """What any chain of regressions keeps: all rows, all observed values, no gap, and fills near the observed range."""
    columns = ["quantity", "price", "tax", "discount"]
    rows = _chain_rows(read).withColumn("gap", F.col("tax").isNull()).withColumn("gap_q", F.col("quantity").isNull())
    filled = ChainedImputer(columns).fit(rows).transform(rows)
    nulls = sum((F.col(c).isNull().cast("bigint") for c in columns[1:]), F.col("quantity").isNull().cast("bigint"))
    return filled.agg(F.count("*").alias("rows"), F.sum(nulls).alias("nulls_left"), F.round(F.sum(F.when(~F.col("gap_q"), F.col("quantity"))), 2).alias("observed_quantity"),
                      F.round(F.sum(F.when(~F.col("gap"), F.col("tax"))), 2).alias("observed_tax"), F.count_if("gap").alias("filled_tax"),
                      F.coalesce(F.bool_and(F.when(F.col("gap"), F.col("tax").between(-30, 70))), F.lit(True)).alias("in_reach"))


@query("median_ordinal_onehot", f"""
SELECT o_orderkey, round(coalesce({miss_sql('o_orderkey', 'o_totalprice')},
  (SELECT median({miss_sql('o_orderkey', 'o_totalprice')}) FROM orders)), 4) AS num_imp__price,
o_custkey::DOUBLE AS num_passthrough__o_custkey,
CASE WHEN o_orderkey % 11 = 0 THEN 0 ELSE CAST(substring(o_orderpriority, 1, 1) AS INTEGER) END AS ord__o_orderpriority,
""" + ", ".join(f"CAST(o_orderstatus = '{v}' AS INTEGER) AS \"cat__o_orderstatus_{v}\"" for v in "FOP") + " FROM orders")
def median_ordinal_onehot(read):
    rows = read("orders").withColumns({"price": miss("o_orderkey", "o_totalprice"),
                                       "o_orderpriority": miss("o_orderkey", "o_orderpriority", 11)})
    model = Preprocessor(["price", "o_custkey", "o_orderpriority", "o_orderstatus"], ordinal={"o_orderpriority": None}).fit(rows)
    return model.transform(rows, ["o_orderkey"]).withColumn("num_imp__price", F.round("num_imp__price", 4))


@query("unseen_levels", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN -1 ELSE CASE o_orderstatus WHEN 'F' THEN 1 ELSE 2 END END AS ord__status,
""" + ", ".join(f"CAST(o_orderpriority = '{v}' AS INTEGER) AS \"cat__o_orderpriority_{v}\"" for v in ("1-URGENT", "2-HIGH"))
       + " FROM orders")
def unseen_levels(read):
    rows = read("orders").withColumn("status", F.col("o_orderstatus"))
    train = rows.filter("o_orderstatus <> 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH')")
    model = Preprocessor(["o_orderpriority", "status"], ordinal={"status": None}).fit(train)
    return model.transform(rows, ["o_orderkey"])


@query("many_levels", """
WITH t AS (SELECT l_orderkey, l_linenumber, CAST(l_orderkey AS VARCHAR) AS a, l_partkey::VARCHAR || '/' || l_suppkey::VARCHAR AS b, CASE WHEN l_partkey % 3 <> 0 THEN l_returnflag END AS c FROM lineitem),
f AS (SELECT * FROM t WHERE l_linenumber <= 4),
a AS (SELECT a, row_number() OVER (ORDER BY a::DOUBLE) - 1 AS code FROM (SELECT DISTINCT a FROM f)), b AS (SELECT b, row_number() OVER (ORDER BY b) - 1 AS code FROM (SELECT DISTINCT b FROM f)),
c AS (SELECT c, row_number() OVER (ORDER BY c NULLS FIRST) - 1 AS code FROM (SELECT DISTINCT c FROM f)), n AS (SELECT (SELECT count(*) FROM a) AS na, (SELECT count(*) FROM b) AS nb, (SELECT count(*) FROM c) AS nc)
SELECT l_orderkey, l_linenumber, coalesce(a.code, -1) AS ord__order, coalesce(b.code, -1) AS ord__pair, coalesce(c.code, -1) AS ord__flag,
    '(' || (na + nb + nc) || ',[' || concat_ws(',', a.code, na + b.code, na + nb + c.code) || '],[' || concat_ws(',', if(a.code IS NULL, NULL, '1.0'), if(b.code IS NULL, NULL, '1.0'), if(c.code IS NULL, NULL, '1.0')) || '])' AS features
FROM t CROSS JOIN n LEFT JOIN a ON t.a = a.a LEFT JOIN b ON t.b = b.b LEFT JOIN c ON t.c IS NOT DISTINCT FROM c.c""")
def many_levels(read):
    """Codes and sparse vectors of columns with tens of thousands of levels, fitted on the first four lines of the orders."""
    rows = read("lineitem").select("l_orderkey", "l_linenumber", F.col("l_orderkey").cast("string").alias("order"),
                                   F.concat(F.col("l_partkey").cast("string"), F.lit("/"), F.col("l_suppkey").cast("string")).alias("pair"),
                                   F.when(F.col("l_partkey") % 3 != 0, F.col("l_returnflag")).alias("flag"))
    dictionary = fit_levels(rows.where("l_linenumber <= 4"), ["order", "pair", "flag"])
    told = one_hot(level_codes(rows, dictionary), dictionary)
    return told.select("l_orderkey", "l_linenumber", "ord__order", "ord__pair", "ord__flag", F.col("features").cast("string").alias("features"))


@query("encode_many_levels", """
WITH t AS (SELECT l_orderkey, l_linenumber, l_quantity, CAST(l_orderkey AS VARCHAR) AS a, l_partkey::VARCHAR || '/' || l_suppkey::VARCHAR AS b, CASE WHEN l_partkey % 3 <> 0 THEN l_returnflag END AS c FROM lineitem),
f AS (SELECT * FROM t WHERE l_linenumber <= 4),
a AS (SELECT a, row_number() OVER (ORDER BY a::DOUBLE) AS code FROM (SELECT DISTINCT a FROM f)), b AS (SELECT b, row_number() OVER (ORDER BY b) - 1 AS code FROM (SELECT DISTINCT b FROM f)),
n AS (SELECT count(*) AS nb FROM b)
SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DOUBLE) AS num_passthrough__l_quantity, CAST(coalesce(a.code, -1) AS INTEGER) AS ord__order,
    '(' || nb || ',[' || coalesce(b.code::VARCHAR, '') || '],[' || if(b.code IS NULL, '', '1.0') || '])' AS cat__pair,
    CAST(c IS NULL AS INTEGER) AS flag_missing, CAST(coalesce(c = 'R', false) AS INTEGER) AS flag_r
FROM t CROSS JOIN n LEFT JOIN a ON t.a = a.a LEFT JOIN b ON t.b = b.b""")
def encode_many_levels(read):
    """The preprocessor over columns with more levels than its expressions take: tables of levels, joined."""
    rows = read("lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.col("l_orderkey").cast("string").alias("order"),
                                   F.concat(F.col("l_partkey").cast("string"), F.lit("/"), F.col("l_suppkey").cast("string")).alias("pair"),
                                   F.when(F.col("l_partkey") % 3 != 0, F.col("l_returnflag")).alias("flag"))
    model = Preprocessor(["l_quantity", "order", "pair", "flag"], ordinal={"order": None}, max_levels=100).fit(rows.where("l_linenumber <= 4"))
    told = model.transform(rows, keep=["l_orderkey", "l_linenumber"])
    missing = next(n for n in model.names() if n.startswith("cat__flag_") and n[len("cat__flag_"):] == tx.MISSING_LEVEL)
    return told.select("l_orderkey", "l_linenumber", "num_passthrough__l_quantity", "ord__order", F.col("cat__pair").cast("string").alias("cat__pair"),
                       F.col(f"`{missing}`").alias("flag_missing"), F.col("cat__flag_R").alias("flag_r"))


@query("standardize", """
SELECT l_orderkey, l_linenumber, round((l_quantity - m1) / s1, 5) AS l_quantity, round((l_extendedprice - m2) / s2, 5) AS l_extendedprice
FROM lineitem, (SELECT avg(l_quantity) AS m1, stddev_pop(l_quantity) AS s1, avg(l_extendedprice) AS m2, stddev_pop(l_extendedprice) AS s2 FROM lineitem)""")
def standardize_query(read):
    rows = read("lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    cols = ["l_quantity", "l_extendedprice"]
    return standardize(rows, cols).withColumns({c: F.round(c, 5) + F.lit(0.0) for c in cols})


RAW_EVENTS = """SELECT event_id, date_trunc('second', ts) AS t, event_type,
CASE WHEN event_id % 5 <> 0 THEN value / 50 END AS dist,
CAST(CASE WHEN event_id % 7 <> 0 THEN value / 100 END AS FLOAT)::DOUBLE AS rain,
CAST(CASE WHEN event_id % 3 <> 0 THEN value * 2 END AS FLOAT)::DOUBLE AS wind FROM events"""


def _fill_sql(c: str, role: str) -> str:
    return f"""n_{c} AS (SELECT month(t) AS mo, event_type, {c} AS v, row_number() OVER (PARTITION BY month(t), event_type ORDER BY {c}) - 1 AS pos,
  count(*) OVER (PARTITION BY month(t), event_type) AS n FROM e WHERE day(t) <= 20 AND {c} IS NOT NULL),
x_{c} AS (SELECT event_id, coalesce(e.{c}, (SELECT v FROM n_{c} WHERE mo = month(e.t) AND n_{c}.event_type = e.event_type
  AND pos = {hash_sql('event_id', 42, role)} % n)) AS {c} FROM e)"""


@query("fit_apply_pipeline", f"""
WITH e AS ({RAW_EVENTS}), {_fill_sql('rain', 'Precipitation(in)')}, {_fill_sql('wind', 'Wind_Speed(mph)')},
top AS (SELECT greatest(1.892::DOUBLE, max(dist)) AS hi FROM e WHERE day(t) <= 20)
SELECT event_id, CAST(year(t) AS BIGINT) AS "Event_Year", CAST(day(t) AS BIGINT) AS "Event_Day", CAST(hour(t) AS DOUBLE) AS "Event_Hour",
isodow(t) IN (5, 6) AS "Is_Weekend", CASE WHEN hour(t) BETWEEN 6 AND 21 THEN 'Day' ELSE 'Night' END AS "DayNight_3cat",
round(ln(1 + coalesce(dist, 0)), 6) AS distance_log,
CAST(CASE WHEN dist IS NULL OR dist > hi THEN -1 WHEN dist <= 0.757::DOUBLE THEN 0 WHEN dist <= 1.892::DOUBLE THEN 1 ELSE 2 END AS SMALLINT) AS "Distance_group_ord",
CASE WHEN rain <= 0 THEN 'Dry' WHEN rain <= 0.1::DOUBLE THEN 'Light' WHEN rain <= 0.3::DOUBLE THEN 'Moderate' WHEN rain <= 1 THEN 'Heavy' ELSE 'Extreme' END AS "Precipitation_cat",
round(wind, 4) AS wind
FROM (SELECT event_id, t, dist FROM e) JOIN x_rain USING (event_id) JOIN x_wind USING (event_id), top WHERE day(t) > 20""")
def fit_apply_pipeline(read):
    """Fit on days 1-20, store, load and apply to the later days."""
    k = F.col("event_id")
    rows = read("events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("Start_Time"), F.col("event_type").alias("Borough"),
        F.when(k % 5 != 0, F.col("value") / 50).alias("Distance(mi)"), F.when(k % 7 != 0, F.col("value") / 100).alias("Precipitation(in)"),
        F.when(k % 3 != 0, F.col("value") * 2).alias("Wind_Speed(mph)"), F.dayofmonth("ts").alias("day"))
    cfg = FeatureConfig(keys=["event_id"], draw=["Precipitation(in)", "Wind_Speed(mph)"])
    spark = rows.sparkSession
    folder = scratch_path(spark, "artifacts")
    fit_features(rows.filter("day <= 20").drop("day"), cfg).save(spark, folder)
    out = FeatureModel.load(spark, folder).transform(rows.filter("day > 20").drop("day"))
    return out.select("event_id", "Event_Year", "Event_Day", "Event_Hour", "Is_Weekend", "DayNight_3cat",
                      F.round("Distance(mi)_log", 6).alias("distance_log"), "Distance_group_ord", "Precipitation_cat",
                      F.round(F.col("Wind_Speed(mph)").cast("double"), 4).alias("wind"))
