"""Fit on training rows, apply to any rows: derived features, imputers, schema, stored artifacts."""

from __future__ import annotations

import json
import platform
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

import pyspark
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.functions import text as tx
from tabloom.functions.numbers import clip_low, cut, cut_or_first, level_code, number
from tabloom.operators.columns import enforce_schema, q, schema_spec
from tabloom.operators.encode import levels_by_column
from tabloom.operators.impute import ChainedImputer, GroupDrawImputer, KnnImputer, group_medians
from tabloom.plans.clean import driver_age
from tabloom.session import cut_lineage, small_table

# Bins, labels and level orders.
DISTANCE_EDGES, DISTANCE_LABELS = [0.0, 0.757, 1.892], ["Short", "Medium", "Long"]
RAIN_EDGES = [-1e-12, 0.0, 0.1, 0.3, 1.0, float("inf")]
RAIN_LABELS = ["Dry", "Light", "Moderate", "Heavy", "Extreme"]
WEATHER_ORDER = ["CLEAR", "CLOUDY", "FOG", "RAIN", "SNOW", "STORM", "OTHER", "MISSING"]
VISIBILITY_ORDER = ["Normal", "Low", "Missing"]
DROP_AFTER = ["End_Lat", "End_Lng", "Visibility_is_low", "Wind_Speed_zero_flag", "duration_is_outlier_30d",
              "Start_Time", "End_Time", "Start_Time_parsed", "End_Time_parsed", "Event_TS", "Event_Date", "Source",
              "Airport_Code", "Severity_2cat", "Severity_4cat", "zip_code_clean", "Zipcode_clean", "Zip_code_clean",
              "Severity", "Severity_bin", "Distance(mi)", "Precipitation(in)", "Weather_ConditionGroup",
              "Distance_group", "Visibility_2cat", "FARS__SEX", "FARS__SEX_label", "FARS__BODY_TYP"]


@dataclass
class FeatureConfig:
    """Column roles; the defaults are those of the accident table."""

    keys: list[str]
    start: str = "Start_Time"
    end: str = "End_Time"
    distance: str = "Distance(mi)"
    rain: str = "Precipitation(in)"
    draw: list[str] = field(default_factory=lambda: ["Precipitation(in)", "Wind_Speed(mph)", "Wind_Chill(F)"])
    by: list[str] = field(default_factory=lambda: ["Event_Year", "Event_Month", "Borough"])
    weather: str = "Weather_ConditionGroup"
    visibility: str = "Visibility_2cat"
    target: str = "Severity_bin"
    age: str = "FARS__DRIVER_AGE"
    knn: list[str] = field(default_factory=lambda: ["Pressure(in)", "Visibility(mi)", "Temperature(F)", "Humidity(%)"])
    chained: list[str] = field(default_factory=lambda: ["FARS__DRIVER_AGE", "FARS__MAKE", "FARS__ALC_RES",
                                                        "FARS__BODY_TYP", "FARS__SEX"])
    drop: list[str] = field(default_factory=lambda: list(DROP_AFTER))
    seed: int = 42


def core_features(df: DataFrame, cfg: FeatureConfig, levels: dict) -> DataFrame:
    """Time parts, distance and rain features, ordered codes: a few projections, no shuffle.

    Each projection builds on named columns of the one before, which keeps long
    expressions such as the date cleaning from being repeated in the generated code.
    """
    present = [name for name in (cfg.start, cfg.end) if name in df.columns]
    out = df.withColumns({f"{name}_parsed": tx.clean_date_text(q(name).cast("string")) for name in present})
    out = out.withColumns({f"{name}_parsed": tx.parse_date_text(q(f"{name}_parsed")) if name in present
                           else F.lit(None).cast("timestamp_ntz") for name in (cfg.start, cfg.end)})
    out = out.withColumn("Event_TS", F.coalesce(q(f"{cfg.start}_parsed"), q(f"{cfg.end}_parsed")))
    distance = clip_low(number(df, cfg.distance)) if cfg.distance in df.columns else F.lit(None).cast("double")
    rain = (clip_low(number(df, cfg.rain)) if cfg.rain in df.columns else F.lit(0.0)).cast("float")
    out = out.withColumns({
        **tx.date_parts(F.col("Event_TS")), cfg.distance: distance, cfg.rain: rain,
        **{c: (number(df, c) if c in df.columns else F.lit(None).cast("double")).cast("float")
           for c in cfg.draw if c != cfg.rain}})
    edges = [*DISTANCE_EDGES, levels["distance_max"]]
    coded = {
        f"{cfg.distance}_log": F.log1p(F.coalesce(q(cfg.distance), F.lit(0.0))),
        "Distance_group": cut_or_first(F.coalesce(q(cfg.distance), F.lit(-1.0)), edges, DISTANCE_LABELS),
        **rain_features(q(cfg.rain)),
    }
    out = out.withColumns(coded)
    codes = {"Distance_group_ord": level_code(F.col("Distance_group"), DISTANCE_LABELS)}
    for column, order in ((cfg.weather, levels["weather"]), (cfg.visibility, levels["visibility"])):
        if column in df.columns and order:
            codes[f"{column}_ord"] = level_code(q(column).cast("string"), order)
    if cfg.target in df.columns:
        codes[f"{cfg.target}_ord"] = level_code(q(cfg.target).try_cast("bigint").cast("string"), ["0", "1"])
    return out.withColumns(codes)


def rain_features(rain) -> dict:
    """Log and category; single-precision amounts are compared with double edges."""
    return {"Precipitation_log": F.log1p(rain).cast("float"), "Precipitation_cat": cut(rain, RAIN_EDGES, RAIN_LABELS)}


def fit_levels(train: DataFrame, cfg: FeatureConfig) -> dict:
    """Last distance edge and level orders: the fixed order first, unknown levels after it by name."""
    top = train.agg(F.max(number(train, cfg.distance))).first()[0] if cfg.distance in train.columns else None
    named = {c: q(c).cast("string") for c in (cfg.weather, cfg.visibility) if c in train.columns}
    seen = levels_by_column(train, named)

    def order(column: str, fixed: Sequence[str]) -> list[str]:
        return [*fixed, *sorted(set(seen.get(column, [])) - set(fixed))] if column in named else []

    return {"distance_max": max(1.892, top if top is not None else 0.0),
            "weather": order(cfg.weather, WEATHER_ORDER), "visibility": order(cfg.visibility, VISIBILITY_ORDER)}


@dataclass
class FeatureModel:
    """Fitted state. ``transform`` never looks at the statistics of the rows it is given."""

    config: FeatureConfig
    levels: dict
    draws: GroupDrawImputer
    knn: KnnImputer | None
    chained: ChainedImputer | None
    medians: DataFrame
    rows_train: int = 0
    schema: list[dict] = field(default_factory=list)

    def transform(self, df: DataFrame, aligned: bool = True) -> DataFrame:
        cfg = self.config
        core = core_features(df, cfg, self.levels)
        if cfg.age in core.columns:
            core = core.withColumn(cfg.age, driver_age(number(core, cfg.age)))
        out = self.draws.transform(core)
        out = out.withColumns(rain_features(q(cfg.rain)))
        if self.knn and all(c in out.columns for c in self.knn.columns):
            out = self.knn.transform(out, source=core if not set(self.knn.columns) & set(cfg.draw) else None)
        if self.chained and all(c in out.columns for c in self.chained.columns):
            out = self.chained.transform(out)
        out = out.drop(*[c for c in cfg.drop if c not in cfg.keys])
        return enforce_schema(out, self.schema) if aligned else out

    def save(self, spark: SparkSession, folder: str) -> None:
        folder = folder.rstrip("/")
        state = {"config": asdict(self.config), "levels": self.levels, "medians": self.draws.medians,
                 "draw": self.draws.features, "schema": self.schema,
                 "knn": {"columns": self.knn.columns, "k": self.knn.k, "means": self.knn.means} if self.knn else None,
                 "chained": {"columns": self.chained.columns, "medians": self.chained.medians,
                             "steps": self.chained.steps, "rounds": self.chained.rounds} if self.chained else None,
                 "manifest": {"seed": self.config.seed, "rows_train": self.rows_train,
                              "spark": pyspark.__version__, "python": platform.python_version()}}
        table = small_table(spark, [(json.dumps(state, ensure_ascii=False),)], "value string")
        table.coalesce(1).write.mode("overwrite").text(f"{folder}/state")
        self.draws.pools.write.mode("overwrite").parquet(f"{folder}/pools")
        self.medians.write.mode("overwrite").parquet(f"{folder}/group_medians")
        if self.knn:
            self.knn.donors.write.mode("overwrite").parquet(f"{folder}/donors")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> FeatureModel:
        folder = folder.rstrip("/")
        state = json.loads(spark.read.text(f"{folder}/state").first()["value"])
        cfg = FeatureConfig(**state["config"])
        draws = GroupDrawImputer(state["draw"], cfg.by, cfg.keys, cfg.seed, medians=state["medians"],
                                 pools=spark.read.parquet(f"{folder}/pools"))
        knn = KnnImputer(**state["knn"], donors=spark.read.parquet(f"{folder}/donors")) if state["knn"] else None
        chained = ChainedImputer(**state["chained"]) if state["chained"] else None
        return cls(cfg, state["levels"], draws, knn, chained, spark.read.parquet(f"{folder}/group_medians"),
                   state["manifest"]["rows_train"], state["schema"])


def fit_features(train: DataFrame, cfg: FeatureConfig) -> FeatureModel:
    levels = fit_levels(train, cfg)
    core = core_features(train, cfg, levels)
    if cfg.age in core.columns:
        core = core.withColumn(cfg.age, driver_age(number(core, cfg.age)))
    # The fits read these few columns many times; store them once instead of parsing dates anew.
    needed = [*cfg.draw, *cfg.by, *cfg.knn, *cfg.chained]
    core = cut_lineage(core.select(*[q(c) for c in dict.fromkeys(needed) if c in core.columns]))
    draws = GroupDrawImputer([c for c in cfg.draw if c in core.columns], cfg.by, cfg.keys, cfg.seed).fit(core)
    medians = group_medians(core, draws.features, cfg.by)
    knn_columns = [c for c in cfg.knn if c in core.columns]
    knn = KnnImputer(knn_columns).fit(core) if knn_columns else None
    # A chain needs two columns. Those that the draws fill are not part of it, so the
    # unfilled table gives the same fit.
    chain_columns = [c for c in cfg.chained if c in core.columns]
    chained = ChainedImputer(chain_columns).fit(core) if len(chain_columns) >= 2 else None
    model = FeatureModel(cfg, levels, draws, knn, chained, medians, core.count())
    # Types alone are asked for, so no training row is transformed.
    model.schema = schema_spec(model.transform(train.limit(0), aligned=False))
    return model
