"""Exact comparison of values and keys of unlike types, and mismatches by column."""

import itertools
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tablewright.operators import reconcile

NUMBERS = {
    "bigint": ["9007199254740993", "9007199254740992", "0", "-5", "10", "100"],
    "double": ["9007199254740992", "0.1", "-0.0", "10", "1e300", "1e-7", "'NaN'", "-5", "1e22"],
    "float": ["0.1", "10", "-5", "0.5", "1e20", "16777216"],
    "decimal(38,0)": ["1", "10", "100", "9007199254740993", "10000000000000000000000"],
    "decimal(38,19)": ["1.0000000000000000001", "1", "0.1", "0.0000001", "-5", "0"],
    "decimal(10,2)": ["10", "0.1", "0.5", "-5"],
    "int": ["10", "0", "-5", "16777217"],
}


def exact(value):
    """The number that a value stands for; a float for its shortest decimal."""
    return str(Decimal(str(value)).normalize() + 0) if str(value) != "nan" else "nan"


def column(spark, kind, start):
    rows = ", ".join(f"({i}, CAST({v} AS {kind}))" for i, v in enumerate(NUMBERS[kind], start))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(i, v)")


@pytest.mark.parametrize("one, other", list(itertools.combinations(NUMBERS, 2)))
def test_unlike_numbers(spark, one, other):
    a, b = column(spark, one, 0), column(spark, other, 0)
    texts = []
    for df in (a, b):
        # A float is taken for its exact double next to a double, else for its shortest decimal.
        value = "double(v)" if {one, other} == {"float", "double"} else "v"
        rows = df.selectExpr("i", f"string({value}) AS t").orderBy("i").collect()
        texts.append(["nan" if r.t == "NaN" else exact(r.t) for r in rows])
    pairs = a.crossJoin(b.selectExpr("i AS j", "v AS w"))
    left = pairs.selectExpr("i * 100 + j AS k", "v")
    right = pairs.selectExpr("i * 100 + j AS k", "w AS v")
    found = {r.k for r in reconcile.mismatches(left, right, "k", compare="typed").collect()}
    expected = {
        i * 100 + j
        for i, x in enumerate(texts[0])
        for j, y in enumerate(texts[1])
        if x != y
    }
    assert found == expected
    missing = {repr(r.v) for r in reconcile.missing_keys(a, b, "v").collect()}
    values = {repr(r.v) for r in a.collect()}
    kept = {t for t in texts[0] if t not in texts[1]}
    assert len(missing) == len(kept) and missing <= values


def test_the_two_that_used_to_pass(spark):
    for one, other in (
        ("CAST(9007199254740993 AS bigint)", "CAST(9007199254740992 AS double)"),
        ("CAST(1.0000000000000000001 AS decimal(38,19))", "CAST(1 AS decimal(38,0))"),
    ):
        a, b = (spark.sql(f"SELECT 1 AS k, {v} AS v") for v in (one, other))
        report = reconcile.report(a, b, "k", compare="typed").first()
        assert (report.overall_status, report.mismatched_rows) == ("FAIL", 1)
        by_key = reconcile.report(a.select("v"), b.select("v"), "v").first()
        assert (by_key.missing_rows, by_key.extra_rows) == (1, 1)


def test_instants_and_local_times(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        a = spark.sql(
            "SELECT * FROM VALUES (1, TIMESTAMP '2024-03-31 03:30:00'), (2, TIMESTAMP '2024-01-01'),"
            " (3, NULL), (4, TIMESTAMP '2024-01-01') AS t(k, v)"
        )
        b = spark.sql(
            "SELECT * FROM VALUES (1, TIMESTAMP_NTZ '2024-03-31 02:30:00'),"
            " (2, TIMESTAMP_NTZ '2024-01-01'), (3, NULL), (4, NULL) AS t(k, v)"
        )
        found = {r.k for r in reconcile.mismatches(a, b, "k", compare="typed").collect()}
        assert found == {1, 4}
        with pytest.raises(ValueError, match="instant"):
            reconcile.missing_keys(a, b, "v")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_types_with_odd_field_names(spark):
    df = spark.sql("SELECT id AS k, named_struct('a-b', id) AS s FROM range(3)")
    found = reconcile.missing_keys(df, df.filter("k > 0"), ["k", "s"]).collect()
    assert [r.k for r in found] == [0]
    assert reconcile.report(df, df, "s").first().overall_status == "PASS"


@pytest.mark.parametrize("seed", range(4))
def test_by_column_agrees_with_counting_pairs(spark, seed):
    rng = random.Random(seed)

    def table():
        rows = [
            (rng.choice([None, *range(12)]), rng.choice([None, "a", "b"]), rng.choice([None, 1, 2]))
            for _ in range(rng.randrange(25))
        ]
        return rows, spark.createDataFrame(rows, "k int, s string, n int")

    (left, one), (right, other) = table(), table()
    expected = {
        name: sum(x[0] == y[0] and x[i] != y[i] for x in left for y in right)
        for i, name in ((1, "s"), (2, "n"))
    }
    found = reconcile.mismatches_by_column(one, other, "k").collect()
    assert {r.column_name: r.mismatched_pairs for r in found} == expected


def test_ordinary_keys_are_never_taken_apart(spark):
    """The rows that reach the explode are those of keys with several rows on a side."""
    df = spark.range(200).selectExpr("id AS k", "id % 5 AS v")
    twice = df.union(df.filter("k < 3").withColumn("v", F.lit(9)))
    other = df.withColumn("v", F.expr("v + 1"))
    result = reconcile.mismatches_by_column(twice, other, "k")
    assert [tuple(r) for r in result.collect()] == [("v", 203)]
    plan = result._jdf.queryExecution().executedPlan()
    metrics = []

    def walk(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if "QueryStage" in node.nodeName():
            return walk(node.plan())
        if node.nodeName() == "Generate":
            metrics.append(node.metrics().apply("numOutputRows").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(plan)
    # One row of a column for the ordinary keys; two and one rows for each of the other three.
    assert sorted(metrics) == [1, 9]


def test_columns_in_the_report(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = a.selectExpr("v", "k")
    found = reconcile.report(a, b, "k").first()
    assert (found.data_validation, found.overall_status) == ("SKIPPED", "FAIL")
    assert (found.expected_columns, found.actual_columns) == (["k", "v"], ["v", "k"])
    found = reconcile.report(None, b, "k").first()
    assert (found.expected_columns, found.actual_columns) == (None, ["v", "k"])
