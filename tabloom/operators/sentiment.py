"""Lexicon sentiment of long texts: tokens are exploded, scored by a join and averaged per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.columns import q
from tabloom.session import broadcast_if_small

# A small general lexicon (token, polarity, subjectivity); pass your own table for real use.
SMALL_LEXICON = [
    ("good", 0.7, 0.6), ("great", 0.8, 0.75), ("best", 1.0, 0.3), ("clear", 0.1, 0.4), ("new", 0.14, 0.45),
    ("bad", -0.7, 0.67), ("worst", -1.0, 1.0), ("slow", -0.3, 0.4), ("small", -0.25, 0.4), ("dark", -0.15, 0.4),
]


def lexicon_sentiment(df: DataFrame, text: str, keys: Sequence[str], lexicon: DataFrame,
                      keep: Sequence[str] = ()) -> DataFrame:
    """polarity, subjectivity and sign per row with text: means over the tokens in the lexicon.

    Whole texts are read. Tokens of a row stay in its task, so the average is combined
    there and the shuffle carries one row per text. Rows without a hit score 0.
    """
    cols = [*keys, *keep]
    rows = df.filter(q(text).isNotNull())
    words = (rows.select(*[q(c) for c in cols], F.explode_outer(
        F.split(F.lower(q(text)), "[^a-z]+")).alias("token")))
    scored = words.join(broadcast_if_small(lexicon.select("token", "polarity", "subjectivity")), "token", "left")
    means = scored.groupBy(*[q(c) for c in cols]).agg(
        F.coalesce(F.avg("polarity"), F.lit(0.0)).alias("polarity"),
        F.coalesce(F.avg("subjectivity"), F.lit(0.0)).alias("subjectivity"))
    return means.withColumn("sentiment", sign(F.col("polarity")))


def sign(polarity):
    return F.signum(polarity).cast("tinyint")
