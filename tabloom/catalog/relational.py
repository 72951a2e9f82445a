"""Filters, projections, joins, unions and sorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.catalog.base import lat, lat_sql, lng, lng_sql, miss, miss_sql, query
from tabloom.functions.numbers import number_from_text
from tabloom.operators import columns as C
from tabloom.operators import joins as J
from tabloom.operators import tables as TB
from tabloom.operators.neighbors import area_cap, nearest_capped
from tabloom.operators.ranks import group_quantiles
from tabloom.operators.split import disjoint
from tabloom.session import small_table


@query("scan_prune_filter", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_returnflag IN ('A', 'R') AND l_linestatus = 'O'""")
def scan_prune_filter(read):
    rows = read("lineitem").filter(F.col("l_returnflag").isin("A", "R") & (F.col("l_linestatus") == "O"))
    return C.keep_present(rows, ["l_orderkey", "l_linenumber", "l_quantity", "l_not_there"])


@query("bbox_filter", f"""
SELECT * FROM (SELECT c_custkey, {lat_sql('c_custkey')} AS "LATITUDE", {lng_sql('c_custkey')} AS "LONGITUD" FROM customer)
WHERE "LATITUDE" BETWEEN 40.60 AND 40.80 AND "LONGITUD" BETWEEN -74.10 AND -73.90""")
def bbox_filter(read):
    points = read("customer").select("c_custkey", lat("c_custkey").alias("LATITUDE"), lng("c_custkey").alias("LONGITUD"))
    return C.area_filter(points, "COUNTY", [5], ["LATITUDE", "LATITUD"], ["LONGITUD", "LONGITUDE"],
                         box=((40.60, 40.80), (-74.10, -73.90)))


@query("prefix_rename", """
SELECT p_partkey AS x_p_partkey, p_brand AS x_brand, p_type AS x_p_type, p_size AS x_p_size,
       p_retailprice AS x_price
FROM part WHERE substring(p_brand, 1, 7) IN ('Brand#1', 'Brand#2')""")
def prefix_rename(read):
    rows = C.prefix_filter(read("part"), "p_brand", ["Brand#1", "Brand#2"], 7)
    rows = C.rename_variants(rows, {"brand": ["p_label", "p_brand"], "price": ["p_retailprice"]})
    return C.add_prefix(rows.drop("p_name", "p_absent"), "x_")


@query("enforce_schema", """
SELECT event_id, CASE WHEN event_type IN ('click', 'view', 'purchase') THEN event_type END AS event_type,
       CAST(trunc(value) AS INTEGER) AS value, CAST(user_id AS VARCHAR) AS user_id, CAST(NULL AS VARCHAR) AS zip
FROM events""")
def enforce_schema(read):
    events = read("events")
    spec = C.schema_spec(events.select("event_id", "event_type", F.col("value").cast("int"),
                                       F.col("user_id").cast("string"), F.lit(None).cast("string").alias("zip")),
                         {"event_type": ["click", "view", "purchase"]})
    return C.enforce_schema(events.withColumn("extra", F.lit(1)), spec)


@query("drop_all_null", "SELECT event_id, event_type, value FROM events")
def drop_all_null(read):
    rows = read("events").select("event_id", "event_type", F.lit(None).cast("double").alias("nothing"), "value")
    return C.drop_all_null(rows)


@query("info_table", """
SELECT * FROM (
SELECT 0 AS position, 'event_id' AS "column", 'bigint' AS dtype, count(*) AS "rows", count(event_id) AS non_null FROM events
UNION ALL SELECT 1, 'event_type', 'string', count(*), count(event_type) FROM events
UNION ALL SELECT 2, 'value', 'double', count(*), count(CASE WHEN event_id % 7 <> 0 THEN value END) FROM events
UNION ALL SELECT 3, 'nothing', 'double', count(*), 0 FROM events)""")
def info_table(read):
    return C.info_table(read("events").select("event_id", "event_type", miss("event_id", "value").alias("value"),
                                              F.lit(None).cast("double").alias("nothing")))


@query("leak_guard", "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority FROM orders")
def leak_guard(read):
    rows = read("orders").withColumn("Price_band", F.floor(F.col("o_totalprice") / 1000))
    return C.leak_guard(rows, "o_orderstatus", ["price"])


@query("leak_guard_prefix", "SELECT o_orderkey, o_orderstatus, floor(o_totalprice / 1000)::BIGINT AS unit_price FROM orders")
def leak_guard_prefix(read):
    """Only names that start with a stem go; the target stays though its name does."""
    rows = read("orders").select("o_orderkey", "o_orderstatus", F.floor(F.col("o_totalprice") / 1000).alias("unit_price"),
                                 F.col("o_totalprice").alias("Price_total"), F.col("o_totalprice").alias("PRICE"), F.length("o_orderstatus").alias("o_orderstatus_len"))
    return C.leak_guard(rows, "o_orderstatus", ["price", "O_ORDERSTATUS"], prefix_only=True)


@query("join_inner_keys", """
WITH a AS (SELECT l_orderkey, l_partkey, l_suppkey, sum(l_quantity) AS qty FROM lineitem GROUP BY ALL),
     b AS (SELECT l_orderkey, l_partkey, l_suppkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'A' GROUP BY ALL)
SELECT a.l_orderkey, a.l_partkey, a.l_suppkey, qty, n, o_custkey, c_nationkey
FROM a JOIN b USING (l_orderkey, l_partkey, l_suppkey)
JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey""")
def join_inner_keys(read):
    keys = ["l_orderkey", "l_partkey", "l_suppkey"]
    items = read("lineitem")
    a = items.groupBy(*keys).agg(F.sum("l_quantity").alias("qty"))
    b = items.filter("l_returnflag = 'A'").groupBy(*keys).agg(F.count("*").alias("n"))
    both = J.inner_on(a, b, keys)
    orders = read("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    customers = read("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return J.inner_on(J.inner_on(both, orders, ["l_orderkey"]), customers, ["o_custkey"])


@query("lookup_left_fallback", """
SELECT s_suppkey, s_nationkey, coalesce(n_name, CASE s_nationkey % 5 WHEN 0 THEN 'AREA_0' WHEN 1 THEN 'AREA_1' END) AS n_name
FROM supplier LEFT JOIN (SELECT n_nationkey, min(n_name) AS n_name FROM nation WHERE n_nationkey < 15 GROUP BY 1)
ON s_nationkey = n_nationkey""")
def lookup_left_fallback(read):
    rows = read("supplier").select("s_suppkey", "s_nationkey")
    lookup = read("nation").filter("n_nationkey < 15")
    joined = J.lookup_left(rows, lookup.unionAll(lookup), "s_nationkey", "n_nationkey", ["n_name"])
    return J.fill_from_map(joined, "n_name", (F.col("s_nationkey") % 5).cast("string"), {"0": "AREA_0", "1": "AREA_1"})


CAPS = {"HOUSEHOLD": 2.0, "MACHINERY": 1.0, "BUILDING": 4.0}


@query("nearest_capped", f"""
WITH c AS (SELECT c_custkey, {lat_sql('c_custkey')} AS y, {lng_sql('c_custkey')} AS x,
                  CAST(CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 2.0 WHEN 'MACHINERY' THEN 1.0
                       WHEN 'BUILDING' THEN 4.0 ELSE 1.2 END AS FLOAT) AS cap FROM customer),
s AS (SELECT s_suppkey, {lat_sql('s_suppkey', 11)} AS sy, {lng_sql('s_suppkey', 23)} AS sx FROM supplier),
p AS (SELECT c_custkey, s_suppkey, cap, CAST(sqrt((y - sy) * (y - sy) + (x - sx) * (x - sx)) * 111.0::DOUBLE AS FLOAT) AS km,
      row_number() OVER (PARTITION BY c_custkey ORDER BY (y - sy) * (y - sy) + (x - sx) * (x - sx), s_suppkey) AS rn
      FROM c CROSS JOIN s)
SELECT c_custkey, CASE WHEN km <= cap THEN s_suppkey END AS s_suppkey,
       CASE WHEN km <= cap THEN round(km::DOUBLE, 4) END AS km
FROM p WHERE rn = 1""")
def nearest_join(read):
    left = read("customer").select("c_custkey", "c_mktsegment", lat("c_custkey").alias("y"), lng("c_custkey").alias("x"))
    right = read("supplier").select("s_suppkey", lat("s_suppkey", 11).alias("sy"), lng("s_suppkey", 23).alias("sx"))
    out = nearest_capped(left, right, ("y", "x"), ("sy", "sx"), ["s_suppkey"],
                         area_cap(F.col("c_mktsegment"), CAPS), prefix="", distance="km_f")
    return out.select("c_custkey", "s_suppkey", F.round(F.col("km_f").cast("double"), 4).alias("km"))


BOX_SQL = ", ".join(f"('{b}', {ys[0]}::DOUBLE, {ys[1]}::DOUBLE, {xs[0]}::DOUBLE, {xs[1]}::DOUBLE)"
                    for b, (ys, xs) in J.AREA_BOXES.items())


@query("box_join_counts", f"""
WITH b(box, y0, y1, x0, x1) AS (VALUES {BOX_SQL}),
c AS (SELECT {lat_sql('c_custkey')} AS lat, {lng_sql('c_custkey')} AS lng FROM customer)
SELECT box, count(*) AS "count", round(median(lat), 6) AS lat, round(median(lng), 6) AS lng
FROM c JOIN b ON lat BETWEEN y0 AND y1 AND lng BETWEEN x0 AND x1 GROUP BY box""")
def box_join_counts(read):
    points = read("customer").select(lat("c_custkey").alias("lat"), lng("c_custkey").alias("lng"))
    counts = J.box_counts(points, "lat", "lng")
    mid = group_quantiles(J.box_join(points, "lat", "lng"), ["lat", "lng"], ["box"]).groupBy("box").pivot(
        "column", ["lat", "lng"]).agg(F.round(F.max("q0"), 6))
    return counts.join(mid, "box")


@query("union_years", """
SELECT year, "count", round("count" * 100.0::DOUBLE / sum("count") OVER (), 4) AS percent FROM (
SELECT year, count(*) AS "count" FROM (
SELECT DISTINCT o_custkey, o_orderpriority, year(o_orderdate) AS year FROM orders) GROUP BY year)""")
def union_years(read):
    orders = read("orders").withColumn("year", F.year("o_orderdate").cast("bigint"))
    ends = orders.agg(F.min("year"), F.max("year")).first()
    years = range(ends[0], ends[1] + 1) if ends[0] is not None else [0]
    parts = [orders.filter(F.col("year") == y).select("o_custkey", "o_orderpriority", "year") for y in years]
    counts = TB.union_all(parts).distinct().groupBy("year").agg(F.count("*").alias("count"))
    return J.with_share(counts, digits=4)


@query("union_dedup", """
SELECT o_custkey, o_orderdate, o_orderkey FROM (
SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
FROM orders WHERE o_orderstatus IS NOT NULL) WHERE rn = 1""")
def union_dedup(read):
    orders = read("orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus")
    statuses = sorted(r[0] for r in orders.select("o_orderstatus").distinct().dropna().collect())
    parts = [orders.filter(F.col("o_orderstatus") == s).drop("o_orderstatus") for s in statuses]
    return TB.union_distinct_by(parts, ["o_custkey"], ["o_orderdate", "o_orderkey"])


PRIORITIES = ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH"]


@query("target_encode", """
SELECT o_orderkey, CAST(CASE o_orderpriority WHEN '5-LOW' THEN 0 WHEN '4-NOT SPECIFIED' THEN 1 WHEN '3-MEDIUM' THEN 2
       WHEN '2-HIGH' THEN 3 END AS DOUBLE) AS code,
       CASE o_orderpriority WHEN '5-LOW' THEN 0 WHEN '4-NOT SPECIFIED' THEN 1 WHEN '3-MEDIUM' THEN 2 ELSE 3 END AS index
FROM orders WHERE o_orderpriority <> '1-URGENT'""")
def target_encode(read):
    orders = read("orders").select("o_orderkey", "o_orderpriority")
    coded = C.encode_target(orders, "o_orderpriority", "code", PRIORITIES)
    index = small_table(orders.sparkSession, [(p, i) for i, p in enumerate(PRIORITIES)], "o_orderpriority string, index int")
    return J.inner_on(coded, F.broadcast(index), ["o_orderpriority"]).select("o_orderkey", "code", "index")


@query("dropna_sort_limit", f"""
SELECT o_orderkey, o_orderstatus, price FROM (
SELECT o_orderkey, o_orderstatus, {miss_sql('o_orderkey', 'o_totalprice')} AS price FROM orders)
WHERE price IS NOT NULL ORDER BY o_orderstatus, price DESC, o_orderkey LIMIT 100""")
def dropna_sort_limit(read):
    rows = read("orders").select("o_orderkey", "o_orderstatus", miss("o_orderkey", "o_totalprice").alias("price"))
    return TB.sort_rows(rows.dropna(subset=["price"]),
                        [("o_orderstatus", "asc"), ("price", "desc"), ("o_orderkey", "asc")], 100)


@query("null_safe_numeric", """
SELECT event_id, TRY_CAST(CASE WHEN event_id % 3 = 0 THEN NULL ELSE regexp_extract(props, '([0-9]+)', 1) END AS DOUBLE) AS k
FROM events WHERE event_type = 'click'""")
def null_safe_numeric(read):
    rows = C.filter_if_present(C.filter_if_present(read("events"), "event_type", "click"), "PER_TYP", 1)
    digits = F.regexp_extract("props", "([0-9]+)", 1)
    text = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("k"), digits)).otherwise(F.concat(F.lit(" "), digits))
    return rows.select("event_id", number_from_text(text).alias("k"))


@query("splits_disjoint", """
SELECT 'status' AS parts, count(*) = count(DISTINCT o_orderkey) AS apart FROM orders
UNION ALL SELECT 'customer', NOT EXISTS (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderstatus) > 1)""")
def splits_disjoint(read):
    """Order keys and customer keys of the status parts: no key in two parts, and some in several."""
    orders = read("orders")
    statuses = sorted(r[0] for r in orders.select("o_orderstatus").distinct().dropna().collect())
    parts = [orders.filter(F.col("o_orderstatus") == s) for s in statuses]
    rows = [(name, disjoint(parts, [key])) for name, key in (("status", "o_orderkey"), ("customer", "o_custkey"))]
    return small_table(orders.sparkSession, rows, "parts string, apart boolean")
