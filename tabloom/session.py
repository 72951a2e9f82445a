"""Session helpers: a tuned local session, shared scratch space, lineage cuts, size checks."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# A side is broadcast only after its rows and bytes were checked against these bounds.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def build_session(app: str = "tabloom", cores: int | str = "*", shuffle_partitions: int = 8,
                  memory: str = "12g") -> SparkSession:
    """Local session for tests and the bench; a cluster brings its own configuration."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.codegen.maxFields", "400")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's checkpoint dir, or a fresh one if none is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if folder:
        if current is None:
            context.setCheckpointDir(folder)
        return folder
    if current is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tabloom-")
        context.setCheckpointDir(folder)
        return folder
    return current


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder; never reused, never a fixed name."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, so that a lost executor does not lose the data."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fits(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True if ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes; reads no more rows than that."""
    size = F.lit(0)
    for i, field in enumerate(df.schema):
        column = F.col(f"c{i}")
        wide = isinstance(field.dataType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType))
        size = size + (F.coalesce(F.octet_length(column.cast("string")), F.lit(0)) if wide else F.lit(16))
    found = df.toDF(*[f"c{i}" for i in range(len(df.columns))]).limit(max_rows + 1).agg(F.count("*"), F.sum(size)).first()
    return found[0] <= max_rows and (found[1] or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only behind a size check; otherwise Spark shuffles (and AQE splits skew)."""
    return F.broadcast(df) if fits(df, max_rows) else df


def small_table(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """Driver-side facts (limits, levels, scores) as a local relation; goes through Arrow, no Python workers."""
    schema = T.StructType.fromDDL(ddl)
    arrow = to_arrow_schema(schema)
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    arrays = [pa.array(list(c), type=f.type) for c, f in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema)
