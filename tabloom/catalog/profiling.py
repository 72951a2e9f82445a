"""Profiles, frequency tables, audits and chart data."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.catalog.base import lat, lat_sql, lng, lng_sql, miss, miss_sql, query
from tabloom.operators import profile as P
from tabloom.operators import tables as TB
from tabloom.operators.impute import group_medians
from tabloom.operators.ranks import value_ranks

NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
KINDS = {"l_linenumber": "int"}


def _source(c: str) -> str:
    return miss_sql("l_orderkey", c) if c == "l_quantity" else c


def _profile_sql(c: str) -> str:
    return f"""SELECT '{c}' AS "column", '{KINDS.get(c, 'double')}' AS dtype, count(*) AS "count", count(v) AS non_null,
count(*) - count(v) AS missing, round((count(*) - count(v)) * 100.0::DOUBLE / count(*), 3) AS missing_pct,
round(avg(v), 3) AS mean, round(stddev_samp(v), 3) AS std, round(stddev_samp(v) / sqrt(count(v)), 6) AS se_mean,
round(min(v), 3) AS min, round(quantile_cont(v, 0.01), 3) AS p01, round(quantile_cont(v, 0.05), 3) AS p05,
round(quantile_cont(v, 0.25), 3) AS q1, round(quantile_cont(v, 0.5), 3) AS median, round(quantile_cont(v, 0.75), 3) AS q3,
round(quantile_cont(v, 0.95), 3) AS p95, round(quantile_cont(v, 0.99), 3) AS p99, round(max(v), 3) AS max,
round(any_value(q3 - q1), 3) AS iqr, round(any_value(q1 - 1.5::DOUBLE * (q3 - q1)), 3) AS lower_fence,
round(any_value(q3 + 1.5::DOUBLE * (q3 - q1)), 3) AS upper_fence,
count(CASE WHEN v < q1 - 1.5::DOUBLE * (q3 - q1) OR v > q3 + 1.5::DOUBLE * (q3 - q1) THEN 1 END) AS n_outliers_iqr,
round(count(CASE WHEN v < q1 - 1.5::DOUBLE * (q3 - q1) OR v > q3 + 1.5::DOUBLE * (q3 - q1) THEN 1 END) * 100.0::DOUBLE / count(v), 3)
  AS pct_outliers_iqr,
min(CASE WHEN v >= q1 - 1.5::DOUBLE * (q3 - q1) THEN v END) AS whisker_low,
max(CASE WHEN v <= q3 + 1.5::DOUBLE * (q3 - q1) THEN v END) AS whisker_high
FROM (SELECT CAST({_source(c)} AS DOUBLE) + 0.0::DOUBLE AS v FROM lineitem),
     (SELECT quantile_cont(w, 0.25) AS q1, quantile_cont(w, 0.75) AS q3 FROM
       (SELECT CAST({_source(c)} AS DOUBLE) AS w FROM lineitem))"""


def _items(read):
    return read("lineitem").withColumns({"l_quantity": miss("l_orderkey", "l_quantity"),
                                         "l_discount": F.col("l_discount") + F.lit(0.0)})


@query("numeric_profile", "\nUNION ALL\n".join(_profile_sql(c) for c in NUMERIC))
def numeric_profile(read):
    return P.numeric_profile(_items(read), NUMERIC)


@query("describe_table", "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", count(v) AS "count", round(avg(v), 5) AS mean, round(stddev_samp(v), 5) AS std,
round(min(v), 5) AS min, round(quantile_cont(v, 0.25), 5) AS q1, round(quantile_cont(v, 0.5), 5) AS median,
round(quantile_cont(v, 0.75), 5) AS q3, round(max(v), 5) AS max FROM (SELECT CAST({c} AS DOUBLE) AS v FROM part)"""
    for c in ("p_size", "p_retailprice")))
def describe_table(read):
    return P.describe(read("part"), ["p_size", "p_retailprice"], 5)


@query("box_statistics", """
SELECT 'o_totalprice' AS "column", round(any_value(q1), 3) AS q1, round(any_value(q2), 3) AS median, round(any_value(q3), 3) AS q3,
min(CASE WHEN v >= q1 - 1.5::DOUBLE * (q3 - q1) THEN v END) AS whisker_low,
max(CASE WHEN v <= q3 + 1.5::DOUBLE * (q3 - q1) THEN v END) AS whisker_high,
count(CASE WHEN v < q1 - 1.5::DOUBLE * (q3 - q1) OR v > q3 + 1.5::DOUBLE * (q3 - q1) THEN 1 END) AS fliers
FROM (SELECT o_totalprice * o_totalprice / 1000 AS v FROM orders),
     (SELECT quantile_cont(w, 0.25) AS q1, quantile_cont(w, 0.5) AS q2, quantile_cont(w, 0.75) AS q3
      FROM (SELECT o_totalprice * o_totalprice / 1000 AS w FROM orders))""")
def box_statistics(read):
    squared = read("orders").select((F.col("o_totalprice") * F.col("o_totalprice") / 1000).alias("o_totalprice"))
    return P.box_statistics(squared, ["o_totalprice"])


CATEGORICAL = f"""SELECT 'o_orderstatus' AS variable, o_orderstatus AS level FROM orders
UNION ALL SELECT 'priority', {miss_sql('o_orderkey', 'o_orderpriority')} FROM orders"""


def _orders(read):
    return read("orders").select("o_orderstatus", miss("o_orderkey", "o_orderpriority").alias("priority"))


@query("categorical_profile", f"""
SELECT variable, coalesce(level, 'NaN') AS level, count(*) AS "count",
       round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (PARTITION BY variable), 3) AS percent
FROM ({CATEGORICAL}) GROUP BY 1, 2""")
def categorical_profile(read):
    return P.categorical_distribution(_orders(read), ["o_orderstatus", "priority"])


@query("categorical_missing", f"""
SELECT variable, count(*) - count(level) AS missing,
       round((count(*) - count(level)) * 100.0::DOUBLE / count(*), 3) AS missing_pct
FROM ({CATEGORICAL}) GROUP BY variable""")
def categorical_missing(read):
    return P.categorical_missing(_orders(read), ["o_orderstatus", "priority"])


@query("topk_other", """
WITH d AS (SELECT p_brand AS level, count(*) AS n FROM part GROUP BY 1),
r AS (SELECT *, row_number() OVER (ORDER BY n DESC, level) AS rn FROM d)
SELECT 'p_brand' AS variable, CASE WHEN rn < 15 THEN level ELSE 'OTHER' END AS level, CAST(sum(n) AS BIGINT) AS n,
       round(sum(n) * 100.0::DOUBLE / (SELECT count(*) FROM part), 3) AS percent FROM r GROUP BY 2
UNION ALL
SELECT 'p_type', p_type, count(*), round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM part), 3) FROM part GROUP BY 2""")
def topk_other(read):
    return P.top_levels(read("part"), ["p_brand", "p_type"])


@query("freq_table", f"""
SELECT coalesce({miss_sql('o_orderkey', 'o_orderpriority')}, 'Missing') AS priority, count(*) AS "count",
       round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 2) AS percent FROM orders GROUP BY 1""")
def freq_table(read):
    return TB.frequency(_orders(read), "priority")


@query("value_counts_null", f"""
SELECT {miss_sql('o_orderkey', 'o_orderpriority')} AS priority, count(*) AS "count",
       round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 2) AS percent FROM orders GROUP BY 1""")
def value_counts_null(read):
    return TB.frequency(_orders(read), "priority", null_label=None)


@query("crosstab_counts", """
SELECT o_orderstatus, count(*) FILTER (o_orderpriority = '1-URGENT') AS "1-URGENT",
count(*) FILTER (o_orderpriority = '2-HIGH') AS "2-HIGH", count(*) FILTER (o_orderpriority = '3-MEDIUM') AS "3-MEDIUM",
count(*) FILTER (o_orderpriority = '4-NOT SPECIFIED') AS "4-NOT SPECIFIED",
count(*) FILTER (o_orderpriority = '5-LOW') AS "5-LOW" FROM orders GROUP BY 1""")
def crosstab_counts(read):
    return TB.crosstab(read("orders"), "o_orderstatus", "o_orderpriority")


@query("crosstab_props", """
SELECT l_returnflag, round(count(*) FILTER (l_linestatus = 'F')::DOUBLE / count(*), 4) AS "F",
       round(count(*) FILTER (l_linestatus = 'O')::DOUBLE / count(*), 4) AS "O" FROM lineitem GROUP BY 1""")
def crosstab_props(read):
    return TB.crosstab(read("lineitem"), "l_returnflag", "l_linestatus", proportions=True, digits=4)


@query("contingency_cells", """
SELECT l_partkey, l_suppkey, count(*) AS "count", CAST(sum(count(*)) OVER (PARTITION BY l_partkey) AS BIGINT) AS row_total,
       CAST(sum(count(*)) OVER (PARTITION BY l_suppkey) AS BIGINT) AS column_total,
       round(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY l_partkey), 6) AS row_share FROM lineitem GROUP BY 1, 2""")
def contingency_cells(read):
    """Parts by suppliers: too many levels for columns, so every cell is a row with both margins."""
    return TB.contingency(read("lineitem"), "l_partkey", "l_suppkey", digits=6)


@query("crosstab_heavy", """
WITH h AS (SELECT l_suppkey AS k, row_number() OVER (ORDER BY count(*) DESC, l_suppkey) AS pos FROM lineitem GROUP BY 1)
SELECT l_returnflag, count(*) FILTER (pos <= 3) AS heavy, count(*) FILTER (pos > 3) AS "(other)" FROM lineitem JOIN h ON k = l_suppkey GROUP BY 1""")
def crosstab_heavy(read):
    """The three suppliers with the most lines have columns (added up here), the others share one."""
    grid = TB.crosstab(read("lineitem"), "l_returnflag", "l_suppkey", limit=3)
    heavy = [F.col(f"`{c}`") for c in grid.columns if c not in ("l_returnflag", "(other)")]
    return grid.select("l_returnflag", (heavy[0] + heavy[1] + heavy[2]).alias("heavy"), "(other)")


EVENTS = f"SELECT CAST(day(ts) AS BIGINT) AS day, event_type, {miss_sql('event_id', 'value')} AS value FROM events"


def _events(read):
    return read("events").select(F.dayofmonth("ts").cast("bigint").alias("day"), "event_type",
                                 miss("event_id", "value").alias("value"))


@query("group_median", f"""
SELECT day, event_type, 'value' AS feature, round(median(value), 6) AS median FROM ({EVENTS})
WHERE value IS NOT NULL GROUP BY 1, 2""")
def group_median(read):
    return group_medians(_events(read), ["value"], ["day", "event_type"]).withColumn("median", F.round("median", 6))


@query("pool_table", f"""
SELECT day, event_type, 'value' AS "column", value, n, CAST(coalesce(sum(n) OVER (PARTITION BY day, event_type ORDER BY value
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
FROM (SELECT day, event_type, value, count(*) AS n FROM ({EVENTS}) WHERE value IS NOT NULL GROUP BY 1, 2, 3)""")
def pool_table(read):
    return value_ranks(_events(read), ["value"], ["day", "event_type"])


@query("domain_counts", """
SELECT d AS o_orderstatus, count(o_orderkey) AS "count" FROM (VALUES ('F'), ('O'), ('P'), ('X')) t(d)
LEFT JOIN orders ON o_orderstatus = d GROUP BY d""")
def domain_counts(read):
    return TB.domain_counts(read("orders"), "o_orderstatus", ["F", "O", "P", "X"])


def _audit_sql(c: str, expr: str, kind: str, binary: bool, same: str | None) -> str:
    v = f"(SELECT {expr} AS v FROM lineitem)"
    text = "count(DISTINCT v) > 40" if kind == "string" else "false"
    return f"""SELECT '{c}' AS "column", '{kind}' AS dtype, count(v) AS non_null,
round((count(*) - count(v))::DOUBLE / count(*), 6) AS missing_ratio, (count(*) - count(v))::DOUBLE / count(*) > 0.40 AS high_missing,
count(DISTINCT v) AS n_distinct, count(DISTINCT v) <= 1 AS zero_variance, {text} AS high_cardinality,
{str(binary).lower()} AS binary_like, {f"'{same}'" if same else "CAST(NULL AS VARCHAR)"} AS duplicate_of FROM {v}"""


AUDITED = [("l_quantity", "l_quantity", "double", False, None),
           ("l_returnflag", "l_returnflag", "string", False, None),
           ("copy", "l_quantity", "double", False, "l_quantity"),
           ("constant", "1.5::DOUBLE", "double", False, None),
           ("flag", "(CASE WHEN l_tax > 0.04 THEN 1.0 ELSE 0.0 END)::DOUBLE", "double", True, None),
           ("sparse", "CASE WHEN l_orderkey % 2 = 0 AND l_partkey % 3 > 0 THEN l_partkey END", "bigint", False, None)]


@query("column_audit", "\nUNION ALL\n".join(_audit_sql(*a) for a in AUDITED))
def column_audit(read):
    rows = read("lineitem").withColumns({
        "copy": F.col("l_quantity"), "constant": F.lit(1.5),
        "flag": F.when(F.col("l_tax") > 0.04, F.lit(1.0)).otherwise(F.lit(0.0)),
        "sparse": F.when((F.col("l_orderkey") % 2 == 0) & (F.col("l_partkey") % 3 > 0), F.col("l_partkey"))})
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]
    return P.column_audit(rows, [a[0] for a in AUDITED], keys).withColumn("missing_ratio", F.round("missing_ratio", 6))


HEX = f"SELECT {lng_sql('c_custkey')} AS x, {lat_sql('c_custkey')} AS y FROM customer"


@query("hexbin", f"""
WITH p AS ({HEX}), e AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM p),
u AS (SELECT (x - x0) / ((x1 - x0) / 60) AS u, (y - y0) / ((y1 - y0) / 34) AS v FROM p, e),
d AS (SELECT round_even(u, 0) AS a, round_even(v, 0) AS b, floor(u) AS c, floor(v) AS d,
  power(u - round_even(u, 0), 2) + 3 * power(v - round_even(v, 0), 2) AS d1,
  power(u - floor(u) - 0.5::DOUBLE, 2) + 3 * power(v - floor(v) - 0.5::DOUBLE, 2) AS d2 FROM u)
SELECT CAST(CASE WHEN d1 < d2 THEN a * 2 ELSE c * 2 + 1 END AS INTEGER) AS hx,
       CAST(CASE WHEN d1 < d2 THEN b * 2 ELSE d * 2 + 1 END AS INTEGER) AS hy, count(*) AS "count"
FROM d GROUP BY 1, 2""")
def hexbin(read):
    return P.hexbin(read("customer").select(lng("c_custkey").alias("x"), lat("c_custkey").alias("y")), "x", "y")


@query("histogram", """
SELECT 'l_extendedprice' AS "column", bin, round(lo + bin * ((hi - lo) / 30), 4) AS "left", count(*) AS "count" FROM (
SELECT CAST(least(floor((l_extendedprice - lo) / (hi - lo) * 30), 29) AS INTEGER) AS bin, lo, hi
FROM lineitem, (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)) GROUP BY bin, lo, hi
UNION ALL
SELECT 'l_quantity', bin, round(lo + bin * ((hi - lo) / 30), 4), count(*) FROM (
SELECT CAST(least(floor((l_quantity - lo) / (hi - lo) * 30), 29) AS INTEGER) AS bin, lo, hi
FROM lineitem, (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem)) GROUP BY bin, lo, hi""")
def histogram(read):
    return P.histogram(read("lineitem"), ["l_extendedprice", "l_quantity"]).withColumn("left", F.round("left", 4))


STD_EXTRA = {f"net{i}": f"l_extendedprice * {i} - l_quantity" for i in range(2, 9)}
STD_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", *STD_EXTRA]


@query("std_top12", "SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", round(stddev_samp({STD_EXTRA.get(c, c)}), 5) AS std FROM lineitem"""
    for c in STD_COLUMNS) + ") ORDER BY std DESC LIMIT 12")
def std_top12(read):
    rows = read("lineitem").withColumns({"same": F.lit(3.0), **{c: F.expr(x) for c, x in STD_EXTRA.items()}})
    return P.widest_columns(rows, [*STD_COLUMNS, "same"], k=12).withColumn("std", F.round("std", 5))


@query("median_category", f"""
WITH o AS (SELECT o_orderkey, {miss_sql('o_orderkey', 'o_orderpriority')} AS p FROM orders),
c AS (SELECT p, count(*) AS n FROM o WHERE p IS NOT NULL GROUP BY p),
r AS (SELECT p, sum(n) OVER (ORDER BY n DESC, p ROWS UNBOUNDED PRECEDING) AS upto, sum(n) OVER () AS total,
      row_number() OVER (ORDER BY n DESC, p) AS rn FROM c),
m AS (SELECT p AS fill FROM r WHERE upto::DOUBLE / total >= 0.5 ORDER BY rn LIMIT 1)
SELECT o_orderkey, coalesce(p, fill) AS priority FROM o, m""")
def median_category(read):
    rows = read("orders").select("o_orderkey", miss("o_orderkey", "o_orderpriority").alias("priority"))
    return P.fill_median_category(rows, "priority")
