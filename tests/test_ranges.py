"""Range joins against Spark's own join on the same condition, and their plans."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tablewright.operators import ranges
from tablewright.operators.joins import join
from tablewright.operators.ranges import range_join

KINDS = ("INNER", "LEFT", "RIGHT", "FULL", "SEMI", "ANTI")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def small_bins(monkeypatch):
    monkeypatch.setattr(ranges, "BIN", 2)
    monkeypatch.setattr(ranges, "KNOTS", 8)
    monkeypatch.setattr(ranges, "FAN", 3)


@pytest.mark.parametrize("seed, bounds", enumerate(["[)", "[]", "(]", "()"]))
def test_agrees_with_all_pairs(spark, small_bins, seed, bounds):
    """Repeated rows, NULLs, empty, reversed, far and open-ended intervals; points of two scales."""
    rng = random.Random(seed)
    inf, nan = float("inf"), float("nan")

    def value(*odd):
        return rng.choice([None, *odd, rng.randrange(20), rng.randrange(20) / 4, rng.uniform(0, 1000), -3.0])

    points = [(rng.choice([1, 2, None]), value(inf, -inf, nan), i % 7) for i in range(90)]
    spans = []
    for i in range(60):
        low = value(-inf, nan, 5000.0)
        width = rng.choice([0, 0.25, 3, 100, 10_000, inf, nan, -1])
        spans.append((rng.choice([1, 2, None]), low, rng.choice([None, inf]) if low is None else low + width, i % 5))
    p = spark.createDataFrame([(k, None if x is None else float(x), v) for k, x, v in points], "k int, x double, v int")
    s = spark.createDataFrame(
        [(k, None if a is None else float(a), None if b is None else float(b), w) for k, a, b, w in spans],
        "k int, a double, b double, w int",
    )
    low = "<=" if bounds[0] == "[" else "<"
    high = "<=" if bounds[1] == "]" else "<"
    for equal in (None, ("k", "k")):
        also = " AND left.k = right.k" if equal else ""
        for how in KINDS if equal is None else ("FULL",):
            some = how in ("SEMI", "ANTI")
            condition = f"right.a {low} left.x AND left.x {high} right.b{also}"
            keep = ["x", "v"] if some else ["x", "v", "a", ("right", "b", "until"), "w"]
            found = range_join(p, s, ("left", "x"), ("a", "b"), how, keep, equal, bounds)
            assert list(map(repr, rows(found))) == list(map(repr, rows(join(p, s, condition, how, keep, all_pairs=True))))
            condition = f"left.a {low} right.x AND right.x {high} left.b{also}"
            keep = ["a", "w"] if some else ["a", "w", "x"]
            found = range_join(s, p, ("right", "x"), ("a", "b"), how, keep, equal, bounds)
            assert list(map(repr, rows(found))) == list(map(repr, rows(join(s, p, condition, how, keep, all_pairs=True))))


def test_parts_agree_with_all_pairs(spark, small_bins, monkeypatch):
    """The same where each bin is dealt to parts and tasks."""
    monkeypatch.setattr(ranges, "CELL", 2)
    monkeypatch.setattr(ranges, "TASK", 20)
    test_agrees_with_all_pairs(spark, None, 4, "(]")


def test_many_pairs_of_few_rows_are_dealt_to_tasks(spark, monkeypatch):
    """A quarter of the points are one number, which is in all spans; no task has much more than its share."""
    monkeypatch.setattr(ranges, "CELL", 64)
    monkeypatch.setattr(ranges, "TASK", 1 << 14)
    points = spark.range(4000).selectExpr("CASE WHEN id % 4 = 0 THEN 500 ELSE id END AS x", "id AS v")
    spans = spark.range(500).selectExpr("id AS a", "id + 1000 AS b", "id % 2 AS k")
    keyed = points.selectExpr("*", "CAST(v % 3 AS int) AS j")
    for one, equal in ((points, None), (keyed, ("j", "k"))):
        joined = range_join(one, spans, ("left", "x"), ("a", "b"), "INNER", ["v", "a"], equal)
        condition = "a <= x AND x < b" + (" AND j = k" if equal else "")
        expected = join(one, spans, condition, "INNER", ["v", "a"], all_pairs=True)
        assert joined.exceptAll(expected).isEmpty() and expected.exceptAll(joined).isEmpty()
        tasks = joined.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.count("*")).first()
        assert tasks[0] < 4 * ranges.TASK
        assert tasks[1] > 10
    found = range_join(points, spans, ("left", "x"), ("a", "b"), "ANTI", ["v"])
    assert rows(found) == rows(join(points, spans, "a <= x AND x < b", "ANTI", ["v"], all_pairs=True))


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "int", "decimal(12,3)"])
def test_types(spark, small_bins, kind):
    rng = random.Random(kind)

    def value():
        n = rng.randrange(400)
        return {
            "date": date(2020, 1, 1) + timedelta(n),
            "int": n,
            "decimal(12,3)": Decimal(n) / 8,
        }.get(kind, datetime(2020, 3, 28) + timedelta(minutes=7 * n))

    p = spark.createDataFrame([(value(), i) for i in range(80)], f"x {kind}, v int")
    s = spark.createDataFrame([(*sorted([value(), value()]), i) for i in range(40)], f"a {kind}, b {kind}, w int")
    for how in ("INNER", "FULL"):
        found = range_join(p, s, ("left", "x"), ("a", "b"), how)
        assert rows(found) == rows(join(p, s, "a <= x AND x < b", how, all_pairs=True))


def test_empty_inputs_and_one_value(spark):
    p = spark.createDataFrame([(5, 1), (5, 2)], "x int, v int")
    s = spark.createDataFrame([(5, 6), (0, 5), (9, 3)], "a int, b int")
    for one, two in ((p, s), (p.filter("false"), s), (p, s.filter("false"))):
        for how in ("FULL", "ANTI"):
            found = range_join(one, two, ("left", "x"), ("a", "b"), how)
            assert rows(found) == rows(join(one, two, "a <= x AND x < b", how, all_pairs=True))


def test_errors(spark):
    p = spark.createDataFrame([(5, "q", date(2020, 1, 1))], "x int, t string, d date")
    s = spark.createDataFrame([(5, 6)], "a int, b int")
    for point, interval, more in (
        (("left", "t"), ("a", "b"), {}),
        (("left", "d"), ("a", "b"), {}),
        (("left", "y"), ("a", "b"), {}),
        (("middle", "x"), ("a", "b"), {}),
        (("left", "x"), ("a", "c"), {}),
        (("left", "x"), ("a", "b"), {"bounds": "<>"}),
        (("left", "x"), ("a", "b"), {"equal": "x = a"}),
        (("left", "x"), ("a", "b"), {"equal": ("x", "c")}),
    ):
        with pytest.raises(ValueError):
            range_join(p, s, point, interval, **more)


def test_each_pair_is_met_about_once(spark):
    """Long intervals meet all their points, and hardly any row besides, by equality on bins."""
    points = spark.range(20_000).selectExpr("id AS x")
    spans = spark.range(300).selectExpr("id * 60 AS a", "id * 60 + CASE WHEN id % 10 = 0 THEN 9000 ELSE 5 END AS b")
    joined = range_join(points, spans, ("left", "x"), ("a", "b"), "INNER", ["x", "a"])
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert joined.count() == join(points, spans, "a <= x AND x < b", "INNER", ["x", "a"], all_pairs=True).count()
    grid = ranges._Grid(points, "x", "CAST(%s AS double)")
    grid.fit(spans, "a", "b")
    assert grid.top == 2  # of intervals of 5 and of 9,000 numbers
    bins = grid.intervals(spans, "a", "b").groupBy("a").count().agg({"count": "max"}).first()[0]
    assert bins <= 2 * (ranges.FAN - 1) * (grid.top + 1)
    met = grid.points(points, "x").join(grid.intervals(spans, "a", "b"), ["__level", "__node"])
    assert met.count() < 1.1 * joined.count() + 300 * 2 * ranges.BIN


def test_a_hot_bin_is_split(spark):
    """A third of all points in one bin: adaptive execution splits it next to its exchange."""
    points = spark.range(60_000).selectExpr("CASE WHEN id % 3 = 0 THEN 500 ELSE id END AS x", "md5(string(id)) AS p")
    spans = spark.range(60).selectExpr("id * 1000 AS a", "id * 1000 + 1000 AS b")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = range_join(points, spans, ("left", "x"), ("a", "b"), "INNER", ["x", "p", "a"])
        assert len(joined.collect()) == 60_000
        plan = joined._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
