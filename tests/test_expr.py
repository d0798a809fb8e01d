"""Expression helpers and non-standard semantics."""
import math

from pyspark.sql import functions as F

from shelfwise.functions import expr as X


def test_business_size_order(spark):
    sizes = ["ZZ", "46", "XL", "One Size", "S", "XXL", "39", "M", "XS", "L"]
    df = spark.createDataFrame([(s,) for s in sizes], "size string")
    got = [r.size for r in df.orderBy(X.size_rank("size").asc_nulls_last()).collect()]
    assert got == ["XS", "S", "M", "L", "XL", "XXL", "One Size", "39", "46", "ZZ"]


def test_safe_div_and_nulls_last(spark):
    df = spark.createDataFrame([(1.0, 0.0), (2.0, None), (3.0, 4.0)], "a double, b double")
    got = [r.q for r in df.select(X.safe_div("a", "b").alias("q")).collect()]
    assert got == [None, None, 0.75]
    order = [r.q for r in df.select(X.safe_div("a", "b").alias("q")).orderBy(F.col("q").asc_nulls_last()).collect()]
    assert order[0] == 0.75


def test_lifecycle_curve(spark):
    t = list(range(0, 40))
    df = spark.createDataFrame([(x,) for x in t], "t int")
    got = [r.m for r in df.orderBy("t").select(X.lifecycle_mult("t").alias("m")).collect()]

    def ref(x):
        if x < 4:
            return 0.3 + 0.175 * x
        if x < 17:
            return 1.0
        if x < 31:
            return 1.0 - (x - 17) * (0.65 / 14)
        return 0.455
    assert all(math.isclose(a, ref(x), abs_tol=1e-12) for a, x in zip(got, t))


def test_first_n_text(spark):
    df = spark.createDataFrame([(list("abcdefg"),), (list("ab"),)], "xs array<string>")
    got = [r.t for r in df.select(X.first_n_text(F.col("xs"), 5).alias("t")).collect()]
    assert got == ["a, b, c, d, e (+2 more)", "a, b"]


def test_money_rounds_half_up_exactly(spark):
    df = spark.createDataFrame([(1.005,), (0.125,), (2.675,)], "x double")
    got = [float(r.m) for r in df.select(X.money("x").alias("m")).collect()]
    assert got == [1.01, 0.13, 2.68]


def test_ladder_and_stock_status(spark):
    df = spark.createDataFrame([(w,) for w in (0, 16, 17, 30, 31)], "w int")
    got = [r.m for r in df.select(X.ladder("w", [(17, 0.0), (31, 0.2)], 0.4).alias("m")).collect()]
    assert got == [0.0, 0.0, 0.2, 0.2, 0.4]
    s = spark.createDataFrame([(0,), (4,), (5,)], "o int").select(X.stock_status("o").alias("s")).collect()
    assert [r.s for r in s] == ["STOCKOUT", "WATCH", "HEALTHY"]


def test_whole_is_round_and_cast(spark):
    import random
    r = random.Random(5)
    values = [0.49999999999999994, 0.5, 1.5, 2.5, -0.5, -1.5, -0.49999999999999994, 4503599627370495.5, 9007199254740993.0, 0.0, -0.0, None]
    values += [r.randrange(-10**7, 10**7) / 100 * 100 for _ in range(300)] + [r.uniform(-100, 100) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = df.select(F.round("x").cast("long").alias("a"), X.whole("x").alias("b"), F.col("x")).collect()
    assert all(g.a == g.b for g in got), [g for g in got if g.a != g.b]
    small = df.where(F.abs("x") < 1e9).select(F.round("x").cast("int").alias("a"), X.whole("x", "int").alias("b"))
    assert dict(small.dtypes) == {"a": "int", "b": "int"} and all(g.a == g.b for g in small.collect())
