"""Contingency tables with few levels, with many, and with nulls."""

from collections import Counter

from pyspark.sql import functions as F

from tabloom.operators import tables as TB

ROWS = [(i % 7 if i % 11 else None, f"v{i % 40 if i % 3 else 0}" if i % 13 else None) for i in range(2_000)]


def test_contingency(spark):
    df = spark.createDataFrame(ROWS, "a int, n string")
    cells = Counter(r for r in ROWS if None not in r)
    got = {(r["a"], r["n"]): r for r in TB.contingency(df, "a", "n").collect()}
    assert {k: r["count"] for k, r in got.items()} == cells
    for (a, n), r in got.items():
        assert r["row_total"] == sum(x for (b, _), x in cells.items() if b == a)
        assert r["column_total"] == sum(x for (_, m), x in cells.items() if m == n)
        assert r["row_share"] == r["count"] / r["row_total"]
    assert TB.contingency(df.limit(0), "a", "n").count() == 0


def test_crosstab_beyond_the_limit(spark):
    df = spark.createDataFrame(ROWS, "a int, n string")
    few = {r["a"]: r for r in TB.crosstab(df, "a", "n", limit=4).collect()}
    sizes = Counter(n for _, n in ROWS if n is not None)
    heavy = sorted(sizes, key=lambda n: (-sizes[n], n))[:4]
    assert set(few) == {None, *range(7)}
    for a, r in few.items():
        mine = Counter(n for b, n in ROWS if b == a and n is not None)
        assert {n: r[n] for n in heavy} == {n: mine[n] for n in heavy}
        assert r["(other)"] == sum(x for n, x in mine.items() if n not in heavy)
    whole = TB.crosstab(df, "a", "n")
    assert "(other)" not in whole.columns and len(whole.columns) == len(sizes) + 1
    shares = TB.crosstab(df, "a", "n", proportions=True, limit=4).collect()
    assert all(abs(sum(v for k, v in r.asDict().items() if k != "a") - 1) < 1e-9 for r in shares)


def test_crosstab_of_very_many_levels(spark):
    df = spark.range(30_000).select((F.col("id") % 2).alias("a"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("n"))
    got = {r["a"]: r for r in TB.crosstab(df, "a", "n", limit=10).collect()}
    assert [got[a]["0"] for a in (0, 1)] == [5_000, 5_000]
    assert all(sum(v for k, v in r.asDict().items() if k != "a") == 15_000 for r in got.values())
    assert TB.contingency(df, "a", "n").count() == 20_002
