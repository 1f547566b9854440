"""Rules on one table, compiled into one grouping."""

import pytest
from conftest import DATA

from tablewright.operators import checks
from tablewright.plans.queries import QUERIES


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_agrees_with_single_checks(spark):
    child = spark.createDataFrame(
        [(1, "a", 5), (1, "a", None), (2, " ", 7), (None, "b", 7), (None, "b", 9), (3, None, 3_000_000_000)],
        "k int, s string, p bigint",
    )
    parent = spark.createDataFrame([(5,), (5,), (None,), (7,)], "q int")
    two = spark.createDataFrame([(1, "a"), (None, "b")], "x int, y string")
    found = checks.table_summary(
        child,
        [
            checks.unique_rule("u1", "error", "k"),
            checks.unique_rule("u2", "warning", ["k", "s"]),
            checks.unique_rule("u3", "error", "p, k, s"),
            checks.reference_rule("r1", "error", parent, ("p", "q")),
            checks.reference_rule("r2", "warning", parent, ("p", "q"), nulls="ignore"),
            checks.reference_rule("r3", "error", two, [("k", "x"), ("s", "y")]),
            checks.row_rule("w1", "error", "p > 6"),
            checks.row_rule("w2", "error", "k > 100"),
            checks.required_rule("n1", "warning", ["s", "k"]),
        ],
    )
    plain = checks.summary(
        [
            ("u1", "error", checks.unique(child, "k")),
            ("u2", "warning", checks.unique(child, ["k", "s"])),
            ("u3", "error", checks.unique(child, "p, k, s")),
            ("r1", "error", checks.references(child, parent, ("p", "q"))),
            ("r2", "warning", checks.references(child, parent, ("p", "q"), nulls="ignore")),
            ("r3", "error", checks.references(child, two, [("k", "x"), ("s", "y")])),
            ("w1", "error", child.filter("p > 6")),
            ("w2", "error", child.filter("k > 100")),
            ("n1", "warning", child.filter("k IS NULL OR s IS NULL OR trim(s) = ''")),
        ]
    )
    assert found.dtypes == plain.dtypes
    assert rows(found) == rows(plain)
    assert checks.verdict(found).first().status == "INVALID"
    none = checks.table_summary(child.filter("false"), [checks.unique_rule("u", "error", "k"), checks.row_rule("w", "error", "p > 6")])
    assert rows(none) == [("u", "error", 0, "VALID"), ("w", "error", 0, "VALID")]


def test_one_scan_and_one_shuffle(spark):
    plan = QUERIES["check_table_summary"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    for table, scans in (("lineitem", 1), ("orders", 1), ("supplier", 1)):
        assert sum("FileScan" in line and f"{table}.parquet" in line for line in plan.split("\n")) == scans
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_errors(spark):
    df = spark.createDataFrame([(1, "a")], "k int, s string")
    for rules in (
        [],
        [checks.unique_rule("u", "fatal", "k")],
        [checks.unique_rule("u", "error", "absent")],
        [checks.reference_rule("r", "error", df, ("k", "s"))],
        [checks.reference_rule("r", "error", df, ("k", "absent"))],
    ):
        with pytest.raises(ValueError):
            checks.table_summary(df, rules)
