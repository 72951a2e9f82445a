"""Round trips through sinks and sources; every path is a new one in the shared folder."""

from __future__ import annotations

import csv
import io
import os
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from tabloom.catalog.base import query
from tabloom.operators.profile import categorical_missing, numeric_profile
from tabloom.operators.tables import best_row, frequency
from tabloom.sources import readers as RD
from tabloom.sources import sinks as SK
from tabloom.session import scratch_path

ORDERS_DDL = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string")


@query("roundtrip_csv", """
SELECT *, 'said "' || o_orderstatus || '", ok' || chr(10) || 'back\\slash ' || o_orderpriority AS note FROM orders""")
def roundtrip_csv(read):
    """Text with quotes, commas, line breaks and backslashes comes back as it was."""
    orders = read("orders").withColumn("note", F.concat(F.lit('said "'), "o_orderstatus", F.lit('", ok\nback\\slash '), "o_orderpriority"))
    folder = scratch_path(orders.sparkSession, "csv")
    SK.export_dataset(orders, folder, "orders")
    return RD.read_csv(orders.sparkSession, f"{folder}/orders.csv", ORDERS_DDL + ", note string", line_breaks=True)


@query("csv_byte_order_mark", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def csv_byte_order_mark(read):
    """A CSV file that starts with a byte order mark: the first column keeps its plain name."""
    rows = read("customer").select(F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name", "c_mktsegment").alias("value"))
    folder = scratch_path(rows.sparkSession, "mark")
    # One file for each partition; each has the mark and the header in its first line.
    files = rows.repartition(2).sortWithinPartitions("value")
    head = F.when(F.monotonically_increasing_id() % (1 << 33) == 0, F.lit("\ufeffc_custkey,c_name,c_mktsegment\n")).otherwise("")
    files.select(F.concat(head, "value").alias("value")).write.text(folder)
    return RD.read_csv(rows.sparkSession, folder, "c_custkey bigint, c_name string, c_mktsegment string")


@query("read_any_roundtrip", """
SELECT 'preferred' AS kind, n_nationkey, n_name FROM nation
UNION ALL SELECT 'first', r_regionkey, r_name FROM region UNION ALL SELECT 'parquet', n_nationkey, n_name FROM nation""")
def read_any_roundtrip(read):
    """The preferred CSV of a folder, else the first one; and the Parquet export."""
    nation, region = read("nation"), read("region")
    spark = nation.sparkSession
    folder, other = scratch_path(spark, "any"), scratch_path(spark, "any")
    SK.write_csv(region, f"{folder}/a.csv")
    SK.write_csv(nation, f"{folder}/train.csv")
    SK.write_csv(region, f"{other}/b.csv")
    SK.write_csv(nation, f"{other}/c.csv")
    parquet = SK.write_parquet(nation, f"{other}/nation.parquet")
    tables = [("preferred", RD.read_any(spark, folder), "n"), ("first", RD.read_any(spark, other), "r"), ("parquet", RD.read_parquet(spark, parquet), "n")]
    parts = [t.select(F.lit(kind).alias("kind"), F.col(f"{x}_{'nation' if x == 'n' else 'region'}key").alias("n_nationkey"), F.col(f"{x}_name").alias("n_name")) for kind, t, x in tables]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("selection_roundtrip", """
SELECT o_orderkey, o_totalprice, o_shippriority_rank, 'train' AS split FROM (
SELECT o_orderkey, o_totalprice, length(o_orderpriority) AS o_shippriority_rank FROM orders)
UNION ALL SELECT o_orderkey, o_totalprice, NULL, 'target' FROM orders""")
def selection_roundtrip(read):
    """Selected names survive, and the processed split and its target are written by them."""
    orders = read("orders").select("o_orderkey", "o_totalprice", F.length("o_orderpriority").alias("o_shippriority_rank"), "o_custkey")
    spark = orders.sparkSession
    folder = scratch_path(spark, "selection")
    rank = orders.agg(*[F.approx_count_distinct(c).alias(c) for c in orders.columns])
    votes = rank.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.lit(i).alias("index"), F.lit(3).alias("Sum")) for i, c in enumerate(rank.columns)])).alias("e")).select("e.*")
    selected = votes.filter(F.col("feature").isin("o_totalprice", "o_shippriority_rank"))
    SK.write_selection(votes, selected, folder, metrics=votes)
    names = SK.read_selection(spark, folder)
    train = spark.read.parquet(SK.write_processed_split(orders, names, folder, "train", keys=["o_orderkey"]))
    target = spark.read.parquet(SK.write_target(orders, "o_totalprice", folder, "train", ["o_orderkey"]))
    return train.withColumn("split", F.lit("train")).unionByName(target.withColumn("split", F.lit("target")), allowMissingColumns=True)


@query("tests_report", """
WITH t AS (SELECT l_returnflag || l_linestatus AS feature, (count(*) % 97) / 400.0::DOUBLE AS p_value FROM lineitem GROUP BY 1)
SELECT 'all_tests' AS part, feature, p_value FROM t UNION ALL SELECT 'significant', feature, p_value FROM t WHERE p_value < 0.05""")
def tests_report(read):
    """All tests and the significant ones, written and read."""
    items = read("lineitem")
    tests = items.groupBy(F.concat("l_returnflag", "l_linestatus").alias("feature")).agg((F.count("*") % 97 / F.lit(400.0)).alias("p_value"))
    folder = scratch_path(items.sparkSession, "tests")
    SK.write_tests(tests, folder)
    parts = [RD.read_parquet(items.sparkSession, f"{folder}/{n}").withColumn("part", F.lit(n)) for n in ("all_tests", "significant")]
    return parts[0].unionByName(parts[1])


@query("tuning_roundtrip", """
WITH r AS (SELECT o_orderpriority AS "Model", avg(o_totalprice) AS rmse, count(*) AS n FROM orders GROUP BY 1)
SELECT "Model" AS model, n AS n_estimators, CAST("Model" = (SELECT "Model" FROM r ORDER BY rmse LIMIT 1) AS BOOLEAN) AS best FROM r""")
def tuning_roundtrip(read):
    """Results with their parameters as JSON text, stored, read and ranked."""
    orders = read("orders")
    spark = orders.sparkSession
    results = orders.groupBy(F.col("o_orderpriority").alias("Model")).agg(
        F.avg("o_totalprice").alias("VALID_RMSE"), F.to_json(F.struct(F.count("*").alias("n_estimators"))).alias("Best_Params_Grid"))
    folder = scratch_path(spark, "tuning")
    SK.write_tuning(results, folder)
    stored = SK.read_tuning(spark, folder)
    best = best_row(stored.select("Model", "VALID_RMSE", "Best_Params_Grid"), "VALID_RMSE")
    return stored.select(F.col("Model").alias("model"), F.get_json_object("Best_Params_Grid", "$.n_estimators").cast("bigint").alias("n_estimators"),
                         (F.col("Model") == best["Model"]).alias("best"))


@query("roundtrip_report", """
SELECT 'frequency' AS name, count(*) AS "rows" FROM (SELECT DISTINCT o_orderpriority FROM orders)
UNION ALL SELECT 'missing', 2 UNION ALL SELECT 'numeric', 1""")
def roundtrip_report(read):
    orders = read("orders")
    spark = orders.sparkSession
    folder = scratch_path(spark, "report")
    SK.write_report({"numeric": numeric_profile(orders, ["o_totalprice"]),
                     "missing": categorical_missing(orders, ["o_orderstatus", "o_orderpriority"]),
                     "frequency": frequency(orders, "o_orderpriority"), "absent": None}, folder)
    tables = [spark.read.parquet(f"{folder}/{n}").agg(F.lit(n).alias("name"), F.count("*").alias("rows"))
              for n in ("numeric", "missing", "frequency")]
    return tables[0].unionAll(tables[1]).unionAll(tables[2])


@query("materialize_once", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def materialize_once(read):
    orders = read("orders")
    spark = orders.sparkSession
    path = scratch_path(spark, "slim")
    RD.materialize(spark, path, lambda: orders.groupBy("o_orderstatus").agg(F.count("*").alias("n")))
    return RD.materialize(spark, path, lambda: 1 / 0)


def write_archives(df, folder: str, parts: int, year_of_part: int = 2016) -> None:
    """Test data for the archive reader: each task streams its rows into the CSV member of one ZIP."""
    names = df.columns
    os.makedirs(folder, exist_ok=True)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        path = f"{folder}/T{year_of_part + part}CSV.zip"
        rows = 0
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("aux_orders.csv", "o_orderkey\n-1\n")
            with archive.open("data/ORDERS.CSV", "w") as raw:
                text = io.TextIOWrapper(raw, encoding="utf-8", newline="")
                out = csv.writer(text)
                out.writerow(names)
                for b in batches:
                    out.writerows(b.itertuples(index=False, name=None))
                    rows += len(b)
                text.flush()
        yield pd.DataFrame({"part": [part], "rows": [rows]})

    df.repartition(parts).mapInPandas(pack, "part int, rows long").count()


@query("zip_members", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(NULL AS VARCHAR) AS absent, true AS has_year FROM orders""")
def zip_members(read):
    orders = read("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    spark = orders.sparkSession
    folder = scratch_path(spark, "zip").removeprefix("file:")
    if "://" in folder:
        raise ValueError("writing the test archives needs a mounted shared folder")
    write_archives(orders, folder, 4)
    table = RD.read_yearly(spark, folder, {"orders": r"orders\.csv$"},
                           {"orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, absent string"})
    return table["orders"].withColumn("has_year", F.col("YEAR").between(2016, 2019)).drop("YEAR")
