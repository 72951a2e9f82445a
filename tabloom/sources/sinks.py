"""Table sinks. Everything is written by the tasks; nothing passes through the driver."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.columns import info_table, q, require
from tabloom.operators.stats import significant
from tabloom.sources.readers import path_exists, read_csv


def write_parquet(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    """CSV with a header. Backslashes are plain text and quotes are doubled, as CSV readers expect."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path


def export_dataset(df: DataFrame, folder: str, stem: str) -> DataFrame:
    """The dataset as Parquet and CSV; returns its info table."""
    folder = folder.rstrip("/")
    write_parquet(df, f"{folder}/{stem}.parquet")
    # The CSV is written from the stored Parquet, so the plan behind ``df`` runs once.
    stored = df.sparkSession.read.parquet(f"{folder}/{stem}.parquet")
    write_csv(stored, f"{folder}/{stem}.csv")
    return info_table(stored)


def write_report(tables: Mapping[str, DataFrame | None], folder: str) -> list[str]:
    """One Parquet folder per table of a report; absent tables are left out."""
    written = []
    for name, df in tables.items():
        if df is not None:
            written.append(write_parquet(df, f"{folder.rstrip('/')}/{name}"))
    return written


def write_tests(tests: DataFrame, folder: str, level: float = 0.05) -> None:
    write_report({"all_tests": tests, "significant": significant(tests, level)}, folder)


def write_processed_split(df: DataFrame, features: Sequence[str], folder: str, split: str,
                          target: str | None = None, keys: Sequence[str] = ()) -> str:
    """Key, chosen features and (except for the test part) the target."""
    names = [*keys, *features, *([target] if target else [])]
    require(df, names)
    return write_parquet(df.select(*[q(n) for n in names]), f"{folder.rstrip('/')}/{split}_processed")


def write_target(df: DataFrame, target: str, folder: str, split: str, keys: Sequence[str] = ()) -> str:
    names = [*keys, target]
    require(df, names)
    return write_parquet(df.select(*[q(n) for n in names]), f"{folder.rstrip('/')}/{split}_target")


def write_selection(votes: DataFrame, selected: DataFrame, folder: str, metrics: DataFrame | None = None) -> None:
    """Votes, selected features with their index, their names as text, and stage-2 metrics."""
    folder = folder.rstrip("/")
    write_csv(votes, f"{folder}/feature_votes")
    write_csv(selected, f"{folder}/selected_features")
    selected.select(F.col("feature").alias("value")).write.mode("overwrite").text(f"{folder}/selected_names")
    if metrics is not None:
        write_csv(metrics, f"{folder}/stage2_metrics")


def read_selection(spark, folder: str) -> list[str]:
    """Selected names in index order (one row per feature, so a short list)."""
    table = read_csv(spark, f"{folder.rstrip('/')}/selected_features")
    return [r["feature"] for r in table.orderBy("index").select("feature").collect()]


def write_tuning(results: DataFrame, folder: str) -> str:
    """The table of tuning results; parameters are JSON text."""
    require(results, ["Model", "VALID_RMSE", "Best_Params_Grid"])
    return write_parquet(results, f"{folder.rstrip('/')}/tuning_results")


def read_tuning(spark, folder: str) -> DataFrame:
    """Stored tuning results, from Parquet or, where another tool wrote them, from CSV."""
    folder = folder.rstrip("/")
    if path_exists(spark, f"{folder}/tuning_results"):
        return spark.read.parquet(f"{folder}/tuning_results")
    return read_csv(spark, f"{folder}/tuning_results.csv")


def write_attributions(values: DataFrame, expected: float, folder: str) -> None:
    folder = folder.rstrip("/")
    write_parquet(values, f"{folder}/values")
    write_parquet(values.sparkSession.range(1).select(F.lit(float(expected)).alias("expected_value")),
                  f"{folder}/expected")
