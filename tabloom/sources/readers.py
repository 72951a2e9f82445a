"""Table scans: CSV, Parquet, file-or-folder, and CSV members inside ZIP archives."""

from __future__ import annotations

import csv
import io
import re
import zipfile
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.operators.columns import strip_headers
from tabloom.operators.tables import union_all


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None,
             null_text: str = "NaN", line_breaks: bool = False, **options) -> DataFrame:
    """CSV with a header; names are trimmed, and both the null text and empty fields are null.

    Quotes inside a field are doubled. ``line_breaks`` allows line breaks inside quoted fields;
    a file is then not split among tasks. Give a schema for large inputs: inferring one costs a
    scan. A byte order mark is skipped by Spark.
    """
    reader = spark.read.option("header", True).option("nullValue", null_text).option("escape", '"')
    reader = reader.option("multiLine", line_breaks).options(**options)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return strip_headers(reader.csv(path))


def read_parquet(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return spark.read.parquet(*([path] if isinstance(path, str) else path))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check on whatever file system the path names."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def _listing(spark: SparkSession, folder: str) -> tuple[bool, list[str]]:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(folder)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(target):
        raise FileNotFoundError(f"path not found: {folder}")
    if not fs.getFileStatus(target).isDirectory():
        return False, [folder]
    return True, sorted(s.getPath().toString() for s in fs.listStatus(target))


def read_any(spark: SparkSession, path: str, preferred: str = "train.csv",
             schema: T.StructType | str | None = None) -> DataFrame:
    """A CSV file, or from a folder the preferred file, else the first CSV in name order."""
    is_folder, names = _listing(spark, path)
    if not is_folder:
        if not path.lower().endswith(".csv"):
            raise ValueError(f"expected .csv, got: {path}")
        return read_csv(spark, path, schema)
    tables = [n for n in names if n.lower().endswith(".csv")]
    if not tables:
        raise FileNotFoundError(f"no CSV files in: {path}")
    return read_csv(spark, next((n for n in tables if n.rsplit("/", 1)[-1] == preferred), tables[0]), schema)


def pick_member(names: Sequence[str], pattern: str) -> str | None:
    """The matching archive member; names without "aux" come first, then name order."""
    hits = [n for n in names if re.search(pattern, n, flags=re.I)]
    return min(hits, key=lambda n: ("aux" in n.lower(), n)) if hits else None


def decode_csv(handle) -> io.TextIOBase:
    """Text over the member: UTF-8, or Latin-1 if a first streaming pass cannot decode it."""
    try:
        for _ in io.TextIOWrapper(handle(), encoding="utf-8-sig"):
            pass
        return io.TextIOWrapper(handle(), encoding="utf-8-sig", newline="")
    except UnicodeDecodeError:
        return io.TextIOWrapper(handle(), encoding="latin-1", newline="")


def read_zip_members(spark: SparkSession, path: str | Sequence[str], pattern: str, schema: T.StructType | str,
                     source: str | None = None, batch_rows: int = 20_000) -> DataFrame:
    """Rows of the matching CSV member of every archive, one archive per task.

    Columns are found by header name; absent ones are null and unreadable numbers too.
    ``source`` adds a column with the archive path. An archive without a match is an error.
    Members are decoded as a stream and leave the task in batches.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    names = [f.name for f in schema]
    label = source or "_archive"
    raw = T.StructType([T.StructField(n, T.StringType()) for n in [*names, label]])

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for files in batches:
            for name, content in zip(files["path"], files["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    member = pick_member(archive.namelist(), pattern)
                    if member is None:
                        raise FileNotFoundError(f"{pattern} not found in {name}")
                    reader = csv.reader(decode_csv(lambda: archive.open(member)))
                    header = [h.strip() for h in next(reader)]
                    at = [header.index(n) if n in header else -1 for n in names]
                    block: list[list] = []
                    for line in reader:
                        block.append([line[i] if 0 <= i < len(line) and line[i] not in ("", "NaN") else None
                                      for i in at] + [name])
                        if len(block) >= batch_rows:
                            yield pd.DataFrame(block, columns=[*names, label])
                            block = []
                    if block:
                        yield pd.DataFrame(block, columns=[*names, label])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    archives = files.select("path").count()
    text = files.repartition(max(archives, 1), "path").mapInPandas(rows, raw)
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema]
    return text.select(*typed, *([F.col(label)] if source else []))


def year_of(c) -> F.Column:
    """Four-digit year in the last part of a path."""
    return F.nullif(F.regexp_extract(c, r"((?:19|20)\d{2})[^/]*$", 1), F.lit("")).try_cast("bigint")


def read_yearly(spark: SparkSession, path: str | Sequence[str], patterns: dict[str, str],
                schemas: dict[str, T.StructType | str], year: str = "YEAR") -> dict[str, DataFrame]:
    """One stacked table per member pattern over all yearly archives, each row with its year."""
    return {name: read_zip_members(spark, path, pattern, schemas[name], "_archive")
            .withColumn(year, year_of(F.col("_archive"))).drop("_archive")
            for name, pattern in patterns.items()}


def stack_years(tables: Sequence[DataFrame]) -> DataFrame:
    return union_all(tables)


def materialize(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Read the stored table, or build and store it first. A half-written one counts as absent."""
    if not path_exists(spark, f"{path.rstrip('/')}/_SUCCESS"):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
