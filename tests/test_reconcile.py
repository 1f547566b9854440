import random
import re
from collections import Counter
from decimal import Decimal

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from tablewright.operators import reconcile


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def counts(report):
    row = report.first()
    return tuple(
        int(row[name])
        for name in (
            "expected_row_count",
            "actual_row_count",
            "missing_rows",
            "extra_rows",
            "mismatched_rows",
            "duplicate_expected_keys",
            "duplicate_actual_keys",
        )
    )


def frame(spark, data, schema="k int, g string, v string"):
    return spark.createDataFrame(data, schema)


def test_a_table_agrees_with_itself(spark):
    df = frame(spark, [(1, "a", "x"), (None, None, None), (2, "b", " y ")])
    row = reconcile.report(df, df, ["k", "g"]).first()
    assert row.overall_status == row.data_validation == row.schema_validation == "PASS"
    assert row.errors == [] and row.warnings == []
    assert counts(reconcile.report(df, df, "k, g")) == (3, 3, 0, 0, 0, 0, 0)


def test_null_keys_and_padding(spark):
    one = frame(spark, [(1, "a", "x "), (None, "b", "y")])
    two = frame(spark, [(1, "a", " x"), (3, "b", "y")])
    assert counts(reconcile.report(one, two, "k")) == (2, 2, 1, 1, 0, 0, 0)
    # Swapping the sides swaps missing and extra.
    assert counts(reconcile.report(two, one, "k")) == (2, 2, 1, 1, 0, 0, 0)
    assert rows(reconcile.missing_keys(one, two, "k")) == [(None,)]
    assert rows(reconcile.extra_keys(one, two, "k")) == [(3,)]
    # A NULL key on both sides is the same key; an extra NULL key is only extra.
    both = frame(spark, [(None, "b", "z")])
    assert counts(reconcile.report(one, both, "k")) == (2, 1, 1, 0, 1, 0, 0)
    assert counts(reconcile.report(frame(spark, [(1, "a", "x")]), both, "k"))[2:5] == (1, 1, 0)


def test_null_value_differs_from_blank(spark):
    one, two = frame(spark, [(1, "a", None)]), frame(spark, [(1, "a", "")])
    assert counts(reconcile.report(one, two, "k"))[4] == 1
    assert rows(reconcile.mismatches_by_column(one, two, "k")) == [
        ("g", Decimal(0)),
        ("v", Decimal(1)),
    ]


def test_duplicate_keys_are_compared_per_pair(spark):
    one = frame(spark, [(1, "a", "x"), (1, "a", "x"), (1, "a", "y"), (2, "c", "z")])
    two = frame(spark, [(1, "a", "x"), (1, "b", "y"), (2, "c", "z"), (2, "c", "z")])
    # Of the six pairs of key 1 two are equal; key 2 has two equal pairs.
    assert counts(reconcile.report(one, two, "k")) == (4, 4, 0, 0, 4, 1, 2)
    row = reconcile.report(one, two, "k").first()
    assert row.row_count_validation == "PASS" and row.overall_status == "FAIL"
    assert row.warnings == ["some keys occur more than once"]
    assert rows(reconcile.duplicate_keys(one, "k")) == [(1, 3)]
    assert rows(reconcile.mismatches(one, two, "k")) == [(1, 3, 2, Decimal(4))]
    assert rows(reconcile.mismatch_rows(one, two, "k")) == [
        (1, "a", "x", 2, 1),
        (1, "a", "y", 1, 0),
        (1, "b", "y", 0, 1),
    ]
    assert rows(reconcile.mismatches_by_column(one, two, "k")) == [
        ("g", Decimal(3)),
        ("v", Decimal(3)),
    ]


def test_duplicates_alone_are_only_a_warning(spark):
    one = frame(spark, [(1, "a", "x"), (1, "a", "x")])
    row = reconcile.report(one, one, "k").first()
    assert row.overall_status == "PASS" and row.warnings


def test_typed_comparison(spark):
    one = frame(spark, [(1, 10, "5"), (2, 10, "5"), (3, 11, " 5")], "k int, n int, s string")
    two = frame(spark, [(1, 10.0, 5), (2, 10.5, 5), (3, 11.0, 6)], "k long, n double, s int")
    assert counts(reconcile.report(one, two, "k"))[4] == 3
    assert counts(reconcile.report(one, two, "k", compare="typed"))[4] == 2
    assert rows(reconcile.mismatches_by_column(one, two, "k", compare="typed")) == [
        ("n", Decimal(1)),
        ("s", Decimal(1)),
    ]
    assert reconcile.missing_keys(one, two, "k").dtypes == [("k", "int")]
    with pytest.raises(ValueError, match="compare"):
        reconcile.report(one, two, "k", compare="loose")


def test_keys_only(spark):
    one, two = spark.range(3), spark.range(1, 4)
    assert counts(reconcile.report(one, two, "id")) == (3, 3, 1, 1, 0, 0, 0)
    with pytest.raises(ValueError, match="besides the keys"):
        reconcile.mismatches_by_column(one, two, "id")


def test_empty_tables(spark):
    one, none = frame(spark, [(1, "a", "x")]), frame(spark, [])
    assert counts(reconcile.report(none, none, "k")) == (0, 0, 0, 0, 0, 0, 0)
    assert reconcile.report(none, none, "k").first().overall_status == "PASS"
    assert counts(reconcile.report(one, none, "k")) == (1, 0, 1, 0, 0, 0, 0)
    assert counts(reconcile.report(none, one, "k")) == (0, 1, 0, 1, 0, 0, 0)
    assert rows(reconcile.compare_counts(one, none)) == [(1, 0, "FAIL")]
    assert rows(reconcile.compare_counts(none, none)) == [(0, 0, "PASS")]
    assert rows(reconcile.mismatches_by_column(none, none, "k"))[0] == ("g", Decimal(0))


def test_schema_difference_skips_the_data(spark):
    df = frame(spark, [(1, "a", "x")])
    turned = df.select("k", "v", "g")
    assert not reconcile.compare_schema(df, turned)
    row = reconcile.report(df, turned, "k").first()
    assert (row.schema_validation, row.data_validation, row.overall_status) == (
        "FAIL",
        "SKIPPED",
        "FAIL",
    )
    assert row.row_count_validation == "PASS" and row.missing_rows is None
    assert len(row.errors) == 1
    with pytest.raises(ValueError, match="columns differ"):
        reconcile.mismatches(df, turned, "k")


@pytest.mark.parametrize("keys", [None, "", [], [" "], "nope", ["k", "nope"]])
def test_missing_keys_fail(spark, keys):
    df = frame(spark, [(1, "a", "x")])
    row = reconcile.report(df, df, keys).first()
    assert (row.schema_validation, row.data_validation, row.overall_status) == (
        "PASS",
        "FAIL",
        "FAIL",
    )
    assert row.errors and row.expected_row_count == 1
    with pytest.raises(ValueError):
        reconcile.missing_keys(df, df, keys)


def test_missing_input_fails(spark):
    df = frame(spark, [(1, "a", "x")])
    for pair, name in (((None, df), "expected"), ((df, None), "actual")):
        row = reconcile.report(*pair, "k").first()
        assert row.overall_status == row.data_validation == "FAIL"
        assert row.errors == [f"there is no {name} table"]


def test_report_columns_are_the_same_in_every_case(spark):
    df = frame(spark, [(1, "a", "x")])
    whole = reconcile.report(df, df, "k").dtypes
    assert reconcile.report(df, df.select("k"), "k").dtypes == whole
    assert reconcile.report(None, df, "k").dtypes == whole


def test_awkward_column_names(spark):
    one = frame(spark, [(1, "a", "x")], "`k 1` int, `a.b` string, `v``w` string")
    two = frame(spark, [(1, "a", "y")], "`k 1` int, `a.b` string, `v``w` string")
    assert counts(reconcile.report(one, two, "k 1"))[4] == 1
    assert reconcile.mismatch_rows(one, two, "k 1").columns[:3] == ["k 1", "a.b", "v`w"]


def test_pair_counts_beyond_bigint(spark):
    tally = spark.createDataFrame(
        [(1, 4_000_000_000, 0), (1, 0, 5_000_000_000)], "k0 int, e long, a long"
    )
    assert reconcile._totals(tally, 1).first().mismatched == 20 * 10**18


def brute_force(expected, actual):
    """The counts by comparing every pair of rows, key first."""
    e_keys, a_keys = Counter(r[:2] for r in expected), Counter(r[:2] for r in actual)

    def same(x, y):
        return x == y if x is None or y is None else x.strip(" ") == y.strip(" ")

    pairs = [
        [not same(x, y) for x, y in zip(e[2:], a[2:])]
        for e in expected
        for a in actual
        if e[:2] == a[:2]
    ]
    return (
        len(expected),
        len(actual),
        len(e_keys.keys() - a_keys.keys()),
        len(a_keys.keys() - e_keys.keys()),
        sum(any(p) for p in pairs),
        sum(n > 1 for n in e_keys.values()),
        sum(n > 1 for n in a_keys.values()),
    ), [sum(p[i] for p in pairs) for i in range(2)]


@pytest.mark.parametrize("seed", range(6))
def test_against_comparing_all_pairs(spark, seed):
    rng = random.Random(seed)

    def table(n):
        return [
            (
                rng.choice([None, 1, 2, 3]),
                rng.choice([None, "a", "b", " a"]),
                rng.choice([None, "x", " x", "y", ""]),
                rng.choice([None, "p", "q "]),
            )
            for _ in range(n)
        ]

    expected, actual = table(rng.randrange(40)), table(rng.randrange(40))
    schema = "k int, s string, v string, w string"
    e, a = frame(spark, expected, schema), frame(spark, actual, schema)
    totals, per_column = brute_force(expected, actual)
    assert counts(reconcile.report(e, a, ["k", "s"])) == totals
    found = dict(rows(reconcile.mismatches_by_column(e, a, ["k", "s"])))
    assert [int(found[c]) for c in ("v", "w")] == per_column
    per_key = rows(reconcile.mismatches(e, a, ["k", "s"]))
    assert sum(r[-1] for r in per_key) == totals[4]


def test_orders_pair(spark):
    """Faults spread over the keys of the orders table, with known counts."""
    if not DATA.endswith("sf0.01"):
        pytest.skip("the counts are those of sf0.01")
    k = F.col("k")
    orders = spark.read.parquet(f"{DATA}/orders.parquet")
    e = orders.selectExpr(
        "o_orderkey AS k", "o_orderstatus AS st", "cast(o_totalprice AS decimal(18,2)) AS amt"
    )
    st = F.when(k % 89 == 0, "X").otherwise(F.col("st"))
    changed = e.filter(k % 97 != 0).withColumn("st", st)
    shifted = e.filter(k % 101 == 0).withColumn("k", k + 1_000_000)
    again = e.filter((k % 103 == 0) & (k % 97 != 0) & (k % 89 != 0))
    a = changed.unionAll(shifted).unionAll(again)
    assert counts(reconcile.report(e, a, "k")) == (15000, 15137, 155, 149, 167, 0, 143)
    assert rows(reconcile.mismatches_by_column(e, a, "k")) == [
        ("amt", Decimal(0)),
        ("st", Decimal(167)),
    ]
    assert counts(reconcile.report(a, e, "k")) == (15137, 15000, 149, 155, 167, 143, 0)


def test_report_is_one_pass_without_a_join(spark):
    df = spark.range(100).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    report = reconcile.report(df, df, "k")
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert plan.count("Exchange hashpartitioning") == 2


def test_a_third_of_both_tables_under_one_key(spark):
    """10^10 pairs share the NULL key; none of them is formed."""
    n = 300_000
    hot = F.when(F.col("id") % 3 != 0, F.col("id"))
    expected = spark.range(n).select(hot.alias("k"), (F.col("id") % 1000).alias("v"))
    actual = spark.range(n).select(hot.alias("k"), (F.col("id") % 500).alias("v"))
    # Under the NULL key there are 10^5 rows on each side: 100 of each expected value
    # and 200 of each actual one, of which 500 values are the same. Of the other keys
    # those with a value of 500 or more differ.
    third = n // 3
    differing = spark.range(n).filter("id % 3 != 0 AND id % 1000 >= 500").count()
    mismatched = third * third - 500 * 100 * 200 + differing
    assert counts(reconcile.report(expected, actual, "k")) == (n, n, 0, 0, mismatched, 1, 1)
    assert rows(reconcile.mismatches_by_column(expected, actual, "k")) == [("v", mismatched)]


def shuffled_bytes(df):
    """Rows, and bytes that the executed plan wrote to its exchanges."""
    found = df.collect()
    total = 0

    def walk(node):
        nonlocal total
        if node.nodeName() == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if "QueryStage" in node.nodeName():
            return walk(node.plan())
        if node.nodeName() == "Exchange":
            total += node.metrics().apply("dataSize").value()
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return sorted(map(tuple, found), key=repr), total


def test_digests_travel_instead_of_wide_rows(spark):
    wide = [f"repeat(md5(concat({i}, k)), 20) AS w{i}" for i in range(5)]
    e = spark.range(2000).selectExpr("id AS k").selectExpr("k", *wide)
    a = e.withColumn("w3", F.expr("CASE WHEN k % 500 = 7 THEN 'other' ELSE w3 END")).filter("k > 3")
    for ask in (reconcile.report, reconcile.mismatches, reconcile.mismatch_rows, reconcile.mismatches_by_column):
        short, few = shuffled_bytes(ask(e, a, "k"))
        long_, many = shuffled_bytes(ask(e, a, "k", exact=True))
        assert short == long_ and short
        # Keys and digests: some 60 bytes a row instead of 3,200. By column, either mode fetches
        # rows for the differing keys only.
        assert few < 2000 * 2 * 150 < many
    plan = reconcile.report(e, a, "k")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Exchange hashpartitioning\(k0#\w+, d0#\w+, d1#\w+", plan)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("compare", ["text", "typed"])
def test_digests_and_values_agree(spark, seed, compare):
    """NULLs beside equal values, swapped columns, signed zeros, nested values and repeated keys."""
    rng = random.Random(seed)
    kind = "k int, s string, t string, d double, b binary, x array<int>, m struct<y: int, z: string>"

    def table():
        data = [
            (
                rng.choice([None, 1, 2, 3, 4, 5]), rng.choice([None, "", "a", "ab"]), rng.choice([None, "", "b", "a"]),
                rng.choice([0.0, -0.0, float("nan"), None]), rng.choice([None, b"", b"a"]),
                rng.choice([None, [1, None], [None, 1], [1]]), rng.choice([None, (None, "q"), (1, None)]),
            )
            for _ in range(30)
        ]
        return spark.createDataFrame(data, kind)

    e, a = table(), table()
    for ask in (reconcile.report, reconcile.mismatches, reconcile.mismatch_rows, reconcile.mismatches_by_column):
        found = [list(map(repr, rows(ask(e, a, "k", compare, exact)))) for exact in (False, True)]
        assert found[0] == found[1] and found[0]
