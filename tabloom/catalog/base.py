"""Registry and the small adapters that give the tables nulls and coordinates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(read)`` where ``read(table)`` scans one of the driver's tables."""
    def add(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(lambda table: spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet"))
        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def miss(key: str, column: str, every: int = 7) -> Column:
    """``column`` with every seventh key set to null."""
    return F.when(F.col(key) % every != 0, F.col(column))


def miss_sql(key: str, column: str, every: int = 7) -> str:
    return f"CASE WHEN {key} % {every} <> 0 THEN {column} END"


def lat(key: str, shift: int = 0) -> Column:
    return F.lit(40.48) + ((F.col(key) * 7919 + shift) % 47000).cast("double") / F.lit(100000.0)


def lng(key: str, shift: int = 0) -> Column:
    return F.lit(-74.26) + ((F.col(key) * 104729 + shift) % 58000).cast("double") / F.lit(100000.0)


def lat_sql(key: str, shift: int = 0) -> str:
    return f"(40.48::DOUBLE + (({key} * 7919 + {shift}) % 47000)::DOUBLE / 100000.0::DOUBLE)"


def lng_sql(key: str, shift: int = 0) -> str:
    return f"(-74.26::DOUBLE + (({key} * 104729 + {shift}) % 58000)::DOUBLE / 100000.0::DOUBLE)"


def hash_sql(key: str, seed: int, role: str) -> str:
    return f"('0x' || substr(md5(concat_ws(':', '{role}', '{seed}', CAST({key} AS VARCHAR))), 1, 8))::BIGINT"
