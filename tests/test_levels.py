"""Level dictionaries against plain Python, at sizes where levels are broadcast and where they are shuffled."""

import pytest
from pyspark.sql import functions as F

from tabloom.functions import text as tx
from tabloom.operators.encode import Preprocessor, assemble, levels_by_column
from tabloom.operators.levels import fit_levels, level_codes, one_hot

ROWS = [(i, "hot" if i % 3 else f"w{i % 40}", None if i % 11 == 0 else str(i % 25 - 4), " " if i % 7 == 0 else f"{i % 5}") for i in range(400)]


def order(levels, numbers):
    rest = sorted((v for v in levels if v != tx.MISSING_LEVEL), key=(lambda v: (float(v), v)) if numbers else str)
    return {v: i for i, v in enumerate([tx.MISSING_LEVEL] * (tx.MISSING_LEVEL in levels) + rest)}


@pytest.mark.parametrize("bound", [1_000, 3])
@pytest.mark.parametrize("lexical", [False, True])
def test_codes_and_vectors(spark, bound, lexical):
    df = spark.createDataFrame(ROWS, "k int, word string, num string, blank string").repartition(5)
    train = df.where("k < 200")
    dictionary = fit_levels(train, ["word", "num", "blank"], lexical)
    text = lambda v: tx.MISSING_LEVEL if v is None or not v.strip() else v
    want = {c: order({text(r[i]) for r in ROWS[:200]}, i > 1 and not lexical) for i, c in ((1, "word"), (2, "num"), (3, "blank"))}
    assert dictionary.sizes == {c: len(v) for c, v in want.items()}
    coded = level_codes(df, dictionary, max_broadcast=bound, frequent=10)
    assert coded.columns == [*df.columns, "ord__word", "ord__num", "ord__blank"]
    got = {r["k"]: r for r in one_hot(coded, dictionary, also=["k"]).collect()}
    assert len(got) == len(ROWS)
    for k, *values in ROWS:
        codes = [want[c].get(text(v), -1) for c, v in zip(want, values)]
        assert [got[k][f"ord__{c}"] for c in want] == codes
        starts = [1, 1 + len(want["word"]), 1 + len(want["word"]) + len(want["num"])]
        assert {int(i): v for i, v in enumerate(got[k]["features"].toArray()) if v} == {**({0: float(k)} if k else {}), **{s + c: 1.0 for s, c in zip(starts, codes) if c >= 0}}


@pytest.mark.parametrize("bound", [1_000_000, 1_000])
def test_a_hundred_thousand_levels(spark, bound):
    df = spark.range(0, 150_000, 1, 6).select(F.when(F.col("id") < 100_000, F.col("id") * 3).otherwise(0).cast("string").alias("v"))
    dictionary = fit_levels(df, ["v"])
    assert dictionary.sizes == {"v": 100_000}
    told = level_codes(df, dictionary, max_broadcast=bound)
    assert told.where(F.col("ord__v") * 3 != F.col("v").cast("long")).count() == 0 and told.count() == 150_000
    assert one_hot(told.limit(5), dictionary).first()["features"].size == 100_000


def test_empty_and_unknown(spark):
    df = spark.createDataFrame([("a",), (None,)], "v string")
    none = fit_levels(df.limit(0), ["v"])
    assert none.sizes == {"v": 0} and {r["ord__v"] for r in level_codes(df, none).collect()} == {-1}
    assert level_codes(df.limit(0), fit_levels(df, ["v"])).count() == 0


@pytest.mark.parametrize("lexical", [False, True])
def test_preprocessor_of_many_levels(spark, lexical):
    """Levels as tables give the codes and places that levels as expressions give."""
    df = spark.createDataFrame(ROWS, "k int, word string, num string, blank string").repartition(3)
    train = df.where("k < 200 and num is not null")
    given = {"num": None, "blank": ["4", "1"]}
    few = Preprocessor(["k", "word", "num", "blank"], ordinal=given, lexical=lexical).fit(train)
    many = Preprocessor(["k", "word", "num", "blank"], ordinal=given, lexical=lexical, max_levels=7).fit(train)
    assert set(many.wide) == {"word", "num"} and many.names() == ["num_passthrough__k", "ord__num", "ord__blank", "cat__word"]
    got = assemble(many.transform(df, keep=["k"]), many.names()).select("k", "ord__num", "ord__blank", "features")
    want = assemble(few.transform(df, keep=["k"]), few.names()).select("k", "ord__num", "ord__blank", "features")
    assert {r["k"]: (r["ord__num"], r["ord__blank"], r["features"].toArray().tolist()) for r in got.collect()} == {
        r["k"]: (r["ord__num"], r["ord__blank"], r["features"].toArray().tolist()) for r in want.collect()}


def test_levels_by_column_bound(spark):
    df = spark.range(30).select(F.col("id").cast("string").alias("a"), (F.col("id") % 2).cast("string").alias("b"))
    columns = {"a": F.col("a"), "b": F.col("b")}
    for limit in (5, 20):
        found = levels_by_column(df, columns, limit, refuse=False)
        assert found["a"] is None and sorted(found["b"]) == ["0", "1"]
        with pytest.raises(ValueError, match="'a'"):
            levels_by_column(df, columns, limit)


def test_vectors_keep_no_name_per_level(spark):
    """The driver holds the sizes of the columns, not a name for each level; small vectors are dense as MLlib has them."""
    df = spark.range(0, 50_000, 1, 4).select("id", F.col("id").cast("string").alias("v"), (F.col("id") % 2).cast("string").alias("w"))
    for dictionary, size in ((fit_levels(df, ["v", "w"]), 50_002), (fit_levels(df, ["w"]), 2)):
        told = one_hot(level_codes(df, dictionary), dictionary, also=["id"])
        assert len(told.schema["features"].json()) < 1_000
        row = told.where("id = 7").first()["features"]
        assert row.size == 1 + size and row.toArray().nonzero()[0].tolist() == ([0, 8, 50_002] if size > 2 else [0, 2])
        assert hasattr(row, "indices") == (size > 2)
    with pytest.raises(Exception, match="null or NaN"):
        gap = df.limit(3).withColumn("gap", F.lit(None).cast("double"))
        one_hot(level_codes(gap, dictionary), dictionary, also=["gap"]).collect()
