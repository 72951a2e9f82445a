"""Numeric coercion, binning and code cleaning as column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMBER_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def number(df: DataFrame, name: str) -> Column:
    """Column ``name`` as a double; whatever is not a number becomes null."""
    kind = df.schema[name].dataType
    c = F.col(f"`{name}`")
    if isinstance(kind, T.StringType):
        return number_from_text(c)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return nan_to_null(c.cast("double"))
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return c.cast("double")
    return F.lit(None).cast("double")


def number_from_text(c: Column) -> Column:
    """``try_cast`` alone also accepts type suffixes such as ``1d``, hence the pattern."""
    text = F.trim(c)
    return F.when(text.rlike(_NUMBER_TEXT), text.try_cast("double"))


def clip_low(c: Column, low: float = 0.0) -> Column:
    """Lower bound that keeps null (``greatest`` alone would drop it)."""
    return F.when(c.isNotNull(), F.greatest(c, F.lit(low)))


def cut(c: Column, edges: Sequence, labels: Sequence[str], include_lowest: bool = True) -> Column:
    """Right-closed bins ``(e0, e1], (e1, e2] ...``; out of range and null give null.

    Edges may be numbers or columns. A repeated edge is an error for literal edges.
    """
    if len(labels) != len(edges) - 1:
        raise ValueError("cut needs one label per interval")
    literal = [e for e in edges if not isinstance(e, Column)]
    if len(literal) == len(edges) and any(b <= a for a, b in zip(edges, edges[1:])):
        raise ValueError("cut edges must increase")

    def as_column(e) -> Column:
        return e if isinstance(e, Column) else F.lit(float(e))

    first = as_column(edges[0])
    in_range = (c >= first) if include_lowest else (c > first)
    chain = F.when(c.isNull() | ~in_range, F.lit(None).cast("string"))
    for upper, label in zip(edges[1:], labels):
        chain = chain.when(c <= as_column(upper), F.lit(label))
    return chain


def cut_or_first(c: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """As :func:`cut`, but edges that do not increase put every row into the first bin."""
    if any(b <= a for a, b in zip(edges, edges[1:])):
        return F.lit(labels[0])
    return cut(c, edges, labels)


def null_codes(c: Column, codes: Sequence[float] = (), low: float | None = None,
               high: float | None = None) -> Column:
    """Null out sentinel codes and values outside ``[low, high]``."""
    bad = [c.isin(*codes)] if codes else []
    if low is not None:
        bad.append(c < low)
    if high is not None:
        bad.append(c > high)
    return F.when(~reduce(lambda a, b: a | b, bad), c) if bad else c


def level_code(c: Column, levels: Sequence[str]) -> Column:
    """Position of the level, -1 for null and for levels that are not listed."""
    position = F.array_position(F.array(*[F.lit(v) for v in levels]), c)
    return F.coalesce(position - 1, F.lit(-1)).cast("smallint")


def sign_bucket(c: Column, low: Column | str, high: Column | str, missing: Column | str,
                at: float = 0.0) -> Column:
    """``low`` for values <= ``at``, ``high`` above, ``missing`` for null."""
    def lit(x):
        return x if isinstance(x, Column) else F.lit(x)
    return F.when(c.isNull(), lit(missing)).when(c <= at, lit(low)).otherwise(lit(high))


def key_hash(df: DataFrame, names: Sequence[str], seed: int, role: str) -> Column:
    """Uniform value in ``[0, 2^32)`` that depends on the row key, the seed and the role only.

    The leading 32 bits of an MD5, which any SQL engine can repeat. Draws of different roles
    (a split and its folds, two imputed columns) are independent of each other.
    """
    parts = [F.coalesce(F.col(f"`{n}`").cast("string"), F.lit("\\N")) for n in names]
    text = F.concat_ws(":", F.lit(role), F.lit(str(int(seed))), *parts)
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
