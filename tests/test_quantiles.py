"""Exact quantiles against Spark's own, which hold a group in one task."""

import random

import pytest
from pyspark.sql import functions as F

from tablewright.operators import aggregates
from tablewright.operators.aggregates import quantiles

SHARES = [("least", 0.0), ("tenth", 0.1), ("middle", 0.5), ("high", 0.973), ("most", 1.0)]


def rows(df):
    """Rows as text, without the sign of zero."""
    return sorted(repr([x + 0.0 if isinstance(x, float) else x for x in r]) for r in df.collect())


def plain(df, by, column):
    return df.groupBy(*by).agg(*[F.expr(f"percentile({column}, {p})").alias(n) for n, p in SHARES])


@pytest.mark.parametrize("slice_rows", [7, 1_000_000])
@pytest.mark.parametrize("kind", ["double", "int", "decimal(10,2)"])
def test_agrees_with_percentile(spark, monkeypatch, slice_rows, kind):
    """NULL groups and values, a group of NULLs, repeated values, zeros of both signs, infinities."""
    monkeypatch.setattr(aggregates, "SLICE", slice_rows)
    rng = random.Random(slice_rows)
    odd = [float("inf"), -float("inf"), float("nan"), 0.0, -0.0] if kind == "double" else [0.0, 3.0]
    data = [
        (rng.choice([None, 1, 1, 1, 2, 3]), rng.choice(["a", None]), rng.choice([None, *odd, 5.0, rng.uniform(-9, 9), 1e6 * rng.random()]))
        for _ in range(400)
    ]
    data += [(9, "z", None), (9, "z", None), (8, "z", 4.25)]
    df = spark.createDataFrame(data, "g int, h string, v double")
    df = df.selectExpr("g AS `a b`", "h", f"CAST(v AS {kind}) AS v")
    found = quantiles(df, ["a b", "h"], "v", SHARES)
    assert rows(found) == rows(plain(df, ["`a b`", "h"], "v"))
    empty = quantiles(df.filter("false"), "h", "v", SHARES)
    assert empty.columns == ["h", *[n for n, _ in SHARES]] and empty.count() == 0


def test_a_group_of_a_third_of_all_rows_is_in_no_task_whole(spark, monkeypatch):
    monkeypatch.setattr(aggregates, "SLICE", 2_000)
    df = spark.range(60_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id % 97 END AS g", "hash(id) % 1000003 / 7D AS v"
    )
    result = quantiles(df, "g", "v", SHARES)
    assert rows(result) == rows(plain(df, ["g"], "v"))
    sizes = df.selectExpr("g", f"{aggregates._slice('v', aggregates._bounds(df))} AS s").groupBy("g", "s").count()
    assert sizes.agg(F.max("count")).first()[0] < 3_000
    plan = result._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    assert "ObjectHashAggregate" not in plan and "collect_list" not in plan
    # Only counts of slices are ordered by group alone; values are ordered in a group's slice.
    windows = [line for line in plan.split("\n") if "Window [" in line]
    assert windows and all("v#" not in line or "slice#" in line.split("windowspecdefinition(")[1] for line in windows)


def test_errors(spark):
    df = spark.createDataFrame([(1, "x", 2)], "g int, s string, v int")
    for by, column, wanted in (
        ("", "v", SHARES), ("g", "v", []), ("g", "s", SHARES), ("g", "v", [("p", 1.5)]), ("g", "v", [("g", 0.5)]),
    ):
        with pytest.raises(ValueError):
            quantiles(df, by, column, wanted)
