"""Projections, filters and schema operators. Only metadata decides which columns they touch."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.numbers import nan_to_null, number, number_from_text
from tabloom.session import small_table

# Bounding box used when an area code is absent (latitude, longitude).
AREA_BOX = ((40.48, 40.95), (-74.26, -73.68))


def q(name: str) -> Column:
    """Column by exact name; names may hold dots, blanks or brackets."""
    return F.col("`" + name.replace("`", "``") + "`")


def require(df: DataFrame, names: Sequence[str]) -> None:
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise KeyError(f"missing columns: {absent}")


def strip_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def nan_as_null(df: DataFrame) -> DataFrame:
    """Aggregates propagate NaN, so a table read from outside keeps one kind of missing value."""
    return df.select(*[nan_to_null(q(f.name)).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else q(f.name)
                       for f in df.schema])


def keep_present(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*[q(n) for n in names if n in df.columns])


def rename_variants(df: DataFrame, variants: Mapping[str, Sequence[str]]) -> DataFrame:
    """Canonical name for the first variant that is present; later variants stay as they are."""
    renames = {}
    for canonical, options in variants.items():
        hit = next((o for o in options if o in df.columns), None)
        if hit and hit != canonical:
            renames[hit] = canonical
    return df.withColumnsRenamed(renames)


def add_prefix(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[q(c).alias(prefix + c) for c in df.columns])


def filter_if_present(df: DataFrame, name: str, value) -> DataFrame:
    return df.filter(q(name) == value) if name in df.columns else df


def area_filter(df: DataFrame, code: str, codes: Sequence, lat: Sequence[str], lng: Sequence[str],
                box=AREA_BOX) -> DataFrame:
    """Code list filter; a bounding box on the first coordinate variant if the code is absent."""
    if code in df.columns:
        return df.filter(q(code).isin(*codes))
    y = next((c for c in lat if c in df.columns), None)
    x = next((c for c in lng if c in df.columns), None)
    if y is None or x is None:
        raise KeyError(f"neither {code} nor coordinates present")
    return df.filter(number(df, y).between(*box[0]) & number(df, x).between(*box[1]))


def prefix_filter(df: DataFrame, name: str, prefixes: Sequence[str], length: int = 3) -> DataFrame:
    return df.filter(F.substring(q(name), 1, length).isin(*prefixes))


def drop_all_null(df: DataFrame) -> DataFrame:
    counts = df.agg(*[F.count(q(c)).alias(f"n{i}") for i, c in enumerate(df.columns)]).first()
    return df.select(*[q(c) for i, c in enumerate(df.columns) if counts[f"n{i}"]])


def columns_by_kind(df: DataFrame) -> dict[str, list[str]]:
    kinds: dict[str, list[str]] = {"numeric": [], "boolean": [], "categorical": [], "other": []}
    for f in df.schema:
        if isinstance(f.dataType, T.NumericType):
            kinds["numeric"].append(f.name)
        elif isinstance(f.dataType, T.BooleanType):
            kinds["boolean"].append(f.name)
        elif isinstance(f.dataType, T.StringType):
            kinds["categorical"].append(f.name)
        else:
            kinds["other"].append(f.name)
    return kinds


def leak_guard(df: DataFrame, target: str, stems: Sequence[str], prefix_only: bool = False) -> DataFrame:
    """Drop columns that look like the target (name contains, or starts with, a stem)."""
    def leaks(name: str) -> bool:
        low = name.lower()
        return any(low.startswith(s.lower()) if prefix_only else s.lower() in low for s in stems)
    return df.select(*[q(c) for c in df.columns if c == target or not leaks(c)])


def resolve_column(df: DataFrame, candidates: Sequence[str]) -> str:
    hit = next((c for c in candidates if c in df.columns), None)
    if hit is None:
        raise ValueError(f"none of {list(candidates)} present")
    return hit


def encode_target(df: DataFrame, target: str, out: str, order: Sequence[str] | None = None) -> DataFrame:
    """Numeric target, or the position in ``order`` for text; rows without a target go."""
    if isinstance(df.schema[target].dataType, T.StringType) and order:
        position = F.array_position(F.array(*[F.lit(v) for v in order]), q(target))
        code = F.when(position > 0, position - 1).cast("double")
    else:
        code = number(df, target)
    return df.withColumn(out, code).filter(F.col(out).isNotNull())


def info_table(df: DataFrame) -> DataFrame:
    """Position, name, type, rows and non-null count of every column, from one pass."""
    wide = df.agg(F.count("*").alias("rows"),
                  *[F.count(q(c)).alias(f"n{i}") for i, c in enumerate(df.columns)])
    parts = [F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"),
                      F.lit(f.dataType.simpleString()).alias("dtype"), F.col("rows"),
                      F.col(f"n{i}").alias("non_null"))
             for i, f in enumerate(df.schema)]
    return wide.select(F.explode(F.array(*parts)).alias("e")).select("e.*")


def dtype_tally(df: DataFrame) -> DataFrame:
    tally: dict[str, int] = {}
    for f in df.schema:
        kind = f.dataType.simpleString()
        tally[kind] = tally.get(kind, 0) + 1
    return small_table(df.sparkSession, sorted(tally.items()), "dtype string, columns bigint")


# ---- recorded schemas -------------------------------------------------------

def schema_spec(df: DataFrame, domains: Mapping[str, Sequence[str]] | None = None) -> list[dict]:
    """Name, type and (for categoricals) the allowed levels of every column, in order."""
    domains = domains or {}
    return [{"name": f.name, "type": f.dataType.simpleString(),
             **({"domain": list(domains[f.name])} if f.name in domains else {})}
            for f in df.schema]


def cast_to(df: DataFrame, name: str, kind: str) -> Column:
    """Cast that yields null instead of failing."""
    source = df.schema[name].dataType
    if isinstance(source, T.StringType) and kind in ("double", "float", "bigint", "int", "smallint", "tinyint"):
        return number_from_text(q(name)).try_cast(kind)
    if kind.startswith("timestamp") and isinstance(source, T.StringType):
        return F.try_to_timestamp(q(name)).cast(kind)
    return q(name).try_cast(kind)


def enforce_schema(df: DataFrame, spec: Sequence[Mapping]) -> DataFrame:
    """Exactly the recorded columns, in order: absent ones null, extra ones gone,
    levels outside the recorded domain null."""
    out = []
    for entry in spec:
        name, kind = entry["name"], entry["type"]
        if name not in df.columns:
            c = F.lit(None).cast(kind)
        elif "domain" in entry:
            text = q(name).cast("string")
            c = F.when(text.isin(*entry["domain"]), text)
        else:
            c = cast_to(df, name, kind)
        out.append(c.alias(name))
    return df.select(*out)


def spec_to_json(spec: Sequence[Mapping]) -> str:
    return json.dumps(list(spec), ensure_ascii=False, indent=2)
