"""Type fix-ups, encoders and scaling, fitted on training rows only."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions import text as tx
from tabloom.functions.numbers import number
from tabloom.operators.columns import q
from tabloom.operators.levels import LevelDictionary, fit_levels, level_codes, one_hot
from tabloom.operators.ranks import exact_quantiles

MAX_LEVELS = 10_000


def levels_by_column(df: DataFrame, columns: dict[str, Column], limit: int = MAX_LEVELS, refuse: bool = True) -> dict[str, list[str] | None]:
    """Distinct values of several text columns in one pass; a column with over ``limit`` is an error, or None unless ``refuse``."""
    if not columns:
        return {}
    entries = F.array(*[F.struct(F.lit(n).alias("c"), c.alias("v")) for n, c in columns.items()])
    distinct = df.select(F.explode(entries).alias("e")).select("e.*").filter(F.col("v").isNotNull()).distinct()
    rows = distinct.limit(limit * len(columns) + 1).collect()
    # A cut list says nothing about a single column, so their sizes are counted then.
    cut = len(rows) > limit * len(columns)
    sizes = {r["c"]: r["count"] for r in distinct.groupBy("c").count().collect()} if cut else Counter(r["c"] for r in rows)
    wide = [n for n in columns if sizes.get(n, 0) > limit]
    if wide and refuse:
        raise ValueError(f"too many levels to encode: {wide}")
    if cut:
        rows = distinct.filter(~F.col("c").isin(wide)).collect()
    found: dict[str, list[str] | None] = {n: None if n in wide else [] for n in columns}
    for r in rows:
        if found[r["c"]] is not None:
            found[r["c"]].append(r["v"])
    return found


def level_order(levels: Sequence[str], lexical: bool = False) -> list[str]:
    """Numeric order if every level is a number, else text order; the missing level goes first."""
    real = [v for v in levels if v != tx.MISSING_LEVEL]
    try:
        ordered = sorted(real) if lexical else sorted(real, key=float)
    except ValueError:
        ordered = sorted(real)
    return [tx.MISSING_LEVEL, *ordered]


@dataclass
class Preprocessor:
    """Numeric columns with exact medians, ordinals as codes, categoricals as 0/1 columns.

    ``fit`` takes two aggregates over the training rows; ``transform`` is one projection.
    Output order: imputed numerics, complete numerics, ordinals, dummies. The levels of a column
    with more than ``max_levels`` are a table that rows are joined to; as a categorical it comes
    out as one sparse vector with a place per level (none for an unknown one).
    """

    features: list[str]
    ordinal: dict[str, list[str] | None] = field(default_factory=dict)
    forced_categorical: list[str] = field(default_factory=list)
    lexical: bool = False
    boolish: list[str] = field(default_factory=list)
    numeric: list[str] = field(default_factory=list)
    numeric_missing: list[str] = field(default_factory=list)
    categorical: list[str] = field(default_factory=list)
    medians: dict = field(default_factory=dict)
    orders: dict = field(default_factory=dict)
    levels: dict = field(default_factory=dict)
    max_levels: int = MAX_LEVELS
    wide: dict[str, LevelDictionary] = field(default_factory=dict)
    wide_missing: dict[str, bool] = field(default_factory=dict)

    def fit(self, train: DataFrame) -> Preprocessor:
        kinds = {f.name: f.dataType for f in train.schema}
        absent = [c for c in self.features if c not in kinds]
        if absent:
            raise KeyError(f"missing columns: {absent}")
        free = [c for c in self.features if c not in self.ordinal and c not in self.forced_categorical]
        texts = [c for c in free if isinstance(kinds[c], T.StringType)]
        facts = train.agg(F.count("*").alias("rows"),
                          *[F.avg(tx.boolish_token(q(c)).cast("double")).alias(f"b_{i}") for i, c in enumerate(texts)],
                          *[F.count(number(train, c)).alias(f"n_{i}") for i, c in enumerate(free)]).first()
        self.boolish = [c for i, c in enumerate(texts) if (facts[f"b_{i}"] or 0.0) >= tx.BOOLISH_SHARE]
        self.numeric = [c for c in free if c not in texts or c in self.boolish]
        values = {c: self._number(train, c) for c in self.numeric}
        narrow = train.select(*[v.alias(f"m{i}") for i, v in enumerate(values.values())])
        counts = narrow.agg(*[F.count(f"m{i}").alias(f"m{i}") for i in range(len(values))]).first() if values else {}
        self.numeric_missing = [c for i, c in enumerate(values) if counts[f"m{i}"] < facts["rows"]]
        cuts = exact_quantiles(narrow, narrow.columns, [0.5]) if values else {}
        self.medians = {c: cuts[f"m{i}"][0] for i, c in enumerate(values)}
        self.categorical = [c for c in self.features if c not in self.numeric and c not in self.ordinal]
        coded = {c: self._text(c) for c in [*self.ordinal, *self.categorical] if self.ordinal.get(c) is None}
        seen = levels_by_column(train, coded, self.max_levels, refuse=False)
        self.wide = {c: fit_levels(train, [c], self.lexical or c not in self.ordinal) for c in coded if seen[c] is None}
        self.wide_missing = {c: not d.table.filter(F.col("level") == tx.MISSING_LEVEL).isEmpty() for c, d in self.wide.items()}
        self.orders = {c: level_order(seen[c], self.lexical) if given is None
                       else [tx.MISSING_LEVEL, *[v for v in given if v != tx.MISSING_LEVEL]]
                       for c, given in self.ordinal.items() if c not in self.wide}
        self.levels = {c: sorted(seen[c]) for c in self.categorical if c not in self.wide}
        return self

    def _text(self, name: str) -> Column:
        return tx.missing_level(q(name).cast("string"))

    def _number(self, df: DataFrame, name: str) -> Column:
        return tx.boolish_value(q(name)).cast("double") if name in self.boolish else number(df, name)

    def outputs(self) -> list[dict]:
        """Name, source column and kind of every output, in order."""
        out = [{"feature": f"num_imp__{c}", "base": c, "kind": "numeric"} for c in self.numeric_missing]
        out += [{"feature": f"num_passthrough__{c}", "base": c, "kind": "numeric"}
                for c in self.numeric if c not in self.numeric_missing]
        out += [{"feature": f"ord__{c}", "base": c, "kind": "ordinal"} for c in self.ordinal]
        for c in self.categorical:
            names = [f"cat__{c}"] if c in self.wide else [f"cat__{c}_{v}" for v in self.levels[c]]
            out += [{"feature": name, "base": c, "kind": "levels" if c in self.wide else "categorical"} for name in names]
        return out

    def names(self) -> list[str]:
        return [o["feature"] for o in self.outputs()]

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        filled = {c: F.coalesce(self._number(df, c), F.lit(m)) for c, m in self.medians.items()}
        out = [q(k) for k in keep]
        out += [filled[c].alias(f"num_imp__{c}") for c in self.numeric_missing]
        out += [filled[c].alias(f"num_passthrough__{c}") for c in self.numeric if c not in self.numeric_missing]
        for c in self.ordinal:
            out.append(q(f"ord__{c}") if c in self.wide else (F.array_position(F.array(*[F.lit(v) for v in self.orders[c]]), self._text(c)) - 1).cast("int").alias(f"ord__{c}"))
        for c in self.categorical:
            out += [q(f"cat__{c}")] if c in self.wide else [(self._text(c) == v).cast("int").alias(f"cat__{c}_{v}") for v in self.levels[c]]
        return self._with_wide(df, keep).select(*out)

    def _with_wide(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """``df`` with codes or vectors of the columns whose levels are tables."""
        if not self.wide:
            return df
        df = df.select(*[q(c) for c in dict.fromkeys([*keep, *self.features])])
        for c, dictionary in self.wide.items():
            df = level_codes(df, dictionary)
            code = q(f"ord__{c}")
            if c in self.ordinal:
                # The missing level is code 0 whether the training rows have it or not.
                after = code + (0 if self.wide_missing[c] else 1)
                known = F.when(self._text(c) == tx.MISSING_LEVEL, F.lit(0)).when(code < 0, F.lit(-1)).otherwise(after)
                df = df.withColumn(f"ord__{c}", known.cast("int"))
            else:
                df = one_hot(df, dictionary, f"cat__{c}").drop(f"ord__{c}")
        return df


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    """Feature vector with positional names, so any feature name works; vectors among the features are laid end to end."""
    names = [f"_x{i}" for i in range(len(features))]
    vectors = {f.name for f in df.schema if isinstance(f.dataType, VectorUDT)}
    wide = df.withColumns({n: q(f) if f in vectors else q(f).cast("double") for n, f in zip(names, features)})
    return VectorAssembler(inputCols=names, outputCol=out).transform(wide).drop(*names)


def standardize(df: DataFrame, columns: Sequence[str], ddof: int = 0) -> DataFrame:
    """Zero mean and unit (population) deviation; a constant column becomes zero."""
    facts = df.agg(*[a for i, c in enumerate(columns) for a in (
        F.avg(q(c)).alias(f"m{i}"), (F.stddev_pop if ddof == 0 else F.stddev_samp)(q(c)).alias(f"s{i}"))]).first()
    return df.withColumns({c: (q(c) - facts[f"m{i}"]) / (facts[f"s{i}"] or 1.0) for i, c in enumerate(columns)})


def fit_scaler(train: DataFrame, column: str = "features", out: str = "scaled"):
    return StandardScaler(withMean=True, withStd=True, inputCol=column, outputCol=out).fit(train)
