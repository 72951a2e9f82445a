"""Correlations, association measures and tests."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from tabloom.catalog.base import miss, miss_sql, query
from tabloom.operators import stats as S

PEARSON = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("pearson_pairs", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem" for a, b in combinations(PEARSON, 2))
    + " UNION ALL SELECT 'l_extendedprice', 'twice', round(corr(l_extendedprice, l_extendedprice * 2 + l_tax), 6) FROM lineitem")
def pearson_pairs(read):
    rows = read("lineitem").withColumn("twice", F.col("l_extendedprice") * 2 + F.col("l_tax"))
    plain = S.pearson_pairs(rows, PEARSON, threshold=None)
    high = S.pearson_pairs(rows, [*PEARSON, "twice"], threshold=0.92)
    return plain.unionByName(high).withColumn("r", F.round("r", 6))


SPEARMAN = {"o_totalprice": "o_totalprice", "o_custkey": "o_custkey", "priority": "priority"}
SPEARMAN_SOURCE = ("SELECT o_totalprice, o_custkey, CASE WHEN o_orderkey % 7 <> 0 THEN "
                   "CAST(substring(o_orderpriority, 1, 1) AS INTEGER) END AS priority FROM orders")


def _spearman_sql(a: str, b: str) -> str:
    return f"""SELECT '{a}' AS a, '{b}' AS b, round(corr(ra, rb), 6) AS rho FROM (
SELECT rank() OVER (ORDER BY {a}) + (count(*) OVER (PARTITION BY {a}) - 1) / 2.0::DOUBLE AS ra,
       rank() OVER (ORDER BY {b}) + (count(*) OVER (PARTITION BY {b}) - 1) / 2.0::DOUBLE AS rb
FROM ({SPEARMAN_SOURCE}) WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"""


@query("spearman_matrix", "\nUNION ALL ".join(
    [_spearman_sql(a, b) for a in SPEARMAN for b in SPEARMAN if a != b]
    + [f"SELECT '{a}', '{a}', 1.0::DOUBLE" for a in SPEARMAN]))
def spearman_matrix(read):
    rows = read("orders").withColumn("priority", F.when(
        F.col("o_orderkey") % 7 != 0, F.substring("o_orderpriority", 1, 1).cast("int")))
    return S.spearman_matrix(rows, list(SPEARMAN), ["o_orderkey"]).withColumn("rho", F.round("rho", 6))


CATS = ["l_returnflag", "l_linestatus", "number"]
CATS_SOURCE = ("SELECT l_returnflag, l_linestatus, CASE WHEN l_orderkey % 7 <> 0 THEN "
               "CAST((l_linenumber + CASE l_returnflag WHEN 'A' THEN 1 ELSE 0 END) AS VARCHAR) END AS number FROM lineitem")


def _cells_sql(a: str, b: str, source: str) -> str:
    """chi2, n, r and k of one pair."""
    return f"""(SELECT n * (sum(o * o::DOUBLE / (ra * cb)) - 1) AS chi2, n, count(DISTINCT u) AS r, count(DISTINCT v) AS k FROM (
SELECT u, v, o, sum(o) OVER (PARTITION BY u) AS ra, sum(o) OVER (PARTITION BY v) AS cb, sum(o) OVER () AS n FROM (
SELECT {a} AS u, {b} AS v, count(*) AS o FROM ({source}) WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1, 2)) GROUP BY n)"""


def _cramers_sql(a: str, b: str) -> str:
    return f"""SELECT '{a}' AS a, '{b}' AS b, round(sqrt(greatest(0, chi2 / n - (k - 1) * (r - 1)::DOUBLE / (n - 1))
/ least(r - (r - 1) * (r - 1)::DOUBLE / (n - 1) - 1, k - (k - 1) * (k - 1)::DOUBLE / (n - 1) - 1)), 6) AS v
FROM {_cells_sql(*sorted((a, b)), CATS_SOURCE)}"""


@query("cramers_v", "\nUNION ALL ".join([_cramers_sql(a, b) for a in CATS for b in CATS if a != b]
                                        + [f"SELECT '{a}', '{a}', 1.0::DOUBLE" for a in CATS]))
def cramers_v(read):
    number = (F.col("l_linenumber") + F.when(F.col("l_returnflag") == "A", 1).otherwise(0)).cast("string")
    rows = read("lineitem").withColumn("number", F.when(F.col("l_orderkey") % 7 != 0, number))
    # The part key has far more than 30 levels and drops out.
    return S.cramers_v(rows, [*CATS, "l_partkey"]).withColumn("v", F.round("v", 6))


RANKED = ["l_quantity", "l_extendedprice", "l_tax"]


def _mann_sql(c: str) -> str:
    source = miss_sql("l_orderkey", c)
    return f"""SELECT '{c}' AS feature, count(*) FILTER (g) AS n1, count(*) FILTER (NOT g) AS n2,
round(sum(r) FILTER (g) - count(*) FILTER (g)::DOUBLE * (count(*) FILTER (g) + 1) / 2, 1) AS u,
round(sum(t * t - 1), 1) AS ties FROM (
SELECT l_linestatus = 'F' AS g, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2.0::DOUBLE AS r,
       count(*) OVER (PARTITION BY v)::DOUBLE AS t
FROM (SELECT l_linestatus, {source} AS v FROM lineitem) WHERE v IS NOT NULL)"""


def _ranked(read):
    return read("lineitem").withColumns({c: miss("l_orderkey", c) + F.lit(0.0) for c in RANKED})


@query("mann_whitney", "\nUNION ALL ".join(_mann_sql(c) for c in RANKED))
def mann_whitney(read):
    out = S.mann_whitney(_ranked(read), RANKED, "l_linestatus", "F", "O")
    return out.withColumns({"u": F.round("u", 1), "ties": F.round("ties", 1)})


CHI_SOURCE = "SELECT l_returnflag, CAST(l_linenumber AS VARCHAR) AS l_linenumber, l_linestatus FROM lineitem"


@query("chi_square", "\nUNION ALL ".join(
    f"""SELECT '{c}' AS feature, CAST(n AS BIGINT) AS n, r, k, round(greatest(chi2, 0), 5) AS stat, (r - 1) * (k - 1) AS dof,
round(sqrt(greatest(chi2, 0) / n / greatest(1, least(r - 1, k - 1))), 6) AS cramers_v FROM {_cells_sql(c, 'l_linestatus', CHI_SOURCE)}"""
    for c in ("l_returnflag", "l_linenumber")))
def chi_square(read):
    out = S.chi_square(read("lineitem"), ["l_returnflag", "l_linenumber"], "l_linestatus")
    return out.withColumns({"stat": F.round("stat", 5), "cramers_v": F.round("cramers_v", 6)})


FISHER = """SELECT 'taxed' AS feature, count(*) FILTER (NOT u AND v = 'F') AS a, count(*) FILTER (NOT u AND v = 'O') AS b,
count(*) FILTER (u AND v = 'F') AS c, count(*) FILTER (u AND v = 'O') AS d
FROM (SELECT l_tax > 0.04 AS u, l_linestatus AS v FROM lineitem)"""


@query("fisher_2x2", f"SELECT *, round(a::DOUBLE * d / (b::DOUBLE * c), 6) AS odds_ratio FROM ({FISHER})")
def fisher_2x2(read):
    rows = read("lineitem").withColumn("taxed", F.col("l_tax") > 0.04)
    return S.fisher_cells(rows, ["taxed"], "l_linestatus").withColumn("odds_ratio", F.round("odds_ratio", 6))


@query("test_battery", "\nUNION ALL ".join(
    [f"SELECT feature, 'Mann-Whitney U' AS test, n1 + n2 AS n, round(u, 4) AS stat, CAST(NULL AS BIGINT) AS dof FROM ({_mann_sql(c)})"
     for c in RANKED]
    + [f"SELECT 'l_returnflag', 'Chi-square', CAST(n AS BIGINT), round(greatest(chi2, 0), 4), (r - 1) * (k - 1) FROM "
       f"{_cells_sql('l_returnflag', 'l_linestatus', CHI_SOURCE)}",
       f"SELECT feature, 'Fisher exact (2x2)', a + b + c + d, round(a::DOUBLE * d / (b::DOUBLE * c), 4), NULL FROM ({FISHER})",
       "SELECT 'l_shipdate', 'Unsupported dtype', NULL, NULL, NULL"]))
def test_battery(read):
    rows = read("lineitem").withColumns({"taxed": F.col("l_tax") > 0.04, "nothing": F.lit(None).cast("double"),
                                         **{c: miss("l_orderkey", c) + F.lit(0.0) for c in RANKED}})
    out = S.battery(rows, "l_linestatus", [*RANKED, "l_returnflag", "taxed", "l_shipdate", "nothing"])
    return out.select("feature", "test", "n", F.round("stat", 4).alias("stat"), "dof")

