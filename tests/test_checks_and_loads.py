import json
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tablewright.functions import Declared
from tablewright.operators import checks
from tablewright.plans import customer_order_summary, expected_summary, load_and_verify
from tablewright.plans.customer_orders import TARGET
from tablewright.plans.queries import Tables, _target
from tablewright.sources import ensure_table, load_overwrite, read_table, table_name


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_column_diff(spark):
    df = spark.range(3).selectExpr("id AS a", "id AS b")
    assert rows(checks.column_diff(df, ["b", "c"])) == [("a", "extra", 3), ("c", "missing", 3)]
    same = checks.column_diff(df, [("b", "int"), ("a", "int")])
    assert rows(same) == []
    assert same.columns == ["column_name", "difference", "table_rows"]


def test_unique(spark):
    data = [(1, "a"), (1, "a"), (None, "b"), (None, "b"), (2, "a")]
    df = spark.createDataFrame(data, "i int, s string")
    assert rows(checks.unique(df, ["i", "s"])) == [(1, "a", 2), (None, "b", 2)]
    with pytest.raises(ValueError):
        checks.unique(df, [])


def test_references(spark):
    child = spark.createDataFrame([(1, "a"), (9, "b"), (None, "c")], "ref int, v string")
    parent = spark.createDataFrame([(1,), (1,), (None,)], "id bigint")
    assert rows(checks.references(child, parent, ("ref", "id"))) == [(9, "b"), (None, "c")]
    ignoring = checks.references(child, parent, [("ref", "id")], nulls="ignore")
    assert rows(ignoring) == [(9, "b")]
    with pytest.raises(ValueError):
        checks.references(child, parent, ("ref", "id"), nulls="maybe")


def test_required(spark):
    df = spark.createDataFrame([(1, "a"), (None, "  "), (None, None), (4, "")], "i int, s string")
    assert rows(checks.required(df, "i, s")) == [("i", 2, 0, 4), ("s", 1, 2, 4)]
    assert rows(checks.required(df.filter("false"), ["i"])) == [("i", 0, 0, 0)]


def test_set_diff(spark):
    a = spark.createDataFrame([(1,), (1,), (None,), (2,)], "x int")
    b = spark.createDataFrame([(2,), (3,), (3,)], "x int")
    assert rows(checks.set_diff(a, b, "x")) == [(1, "missing"), (3, "extra"), (None, "missing")]
    assert rows(checks.set_diff(a, a, "x")) == []


def test_summary_and_verdict(spark):
    none, some = spark.range(0), spark.range(2)
    clean = checks.summary([("a", "error", none), ("b", "warning", some)])
    assert rows(clean) == [("a", "error", 0, "VALID"), ("b", "warning", 2, "WARNING")]
    assert rows(checks.verdict(clean)) == [("VALID", 0, 1)]
    broken = checks.summary([("a", "error", some), ("b", "error", some), ("c", "warning", none)])
    assert rows(checks.verdict(broken)) == [("INVALID", 2, 0)]
    with pytest.raises(ValueError, match="severity"):
        checks.summary([("a", "fatal", none)])
    with pytest.raises(ValueError, match="no rules"):
        checks.summary([])


def test_table_names():
    assert table_name("t", "s", "c") == "`c`.`s`.`t`"
    assert table_name("my`t", "s") == "`s`.`my``t`"
    assert table_name("t") == "`t`"
    with pytest.raises(ValueError):
        table_name("")
    with pytest.raises(ValueError):
        table_name("t", None, "c")


def test_create_load_read_and_verify(spark):
    declared = [Declared("id", "BIGINT"), ("amount", "DECIMAL"), ("note", "VARCHAR")]
    target = ensure_table(spark, "made", declared)
    assert target == "`silver`.`made`"
    assert spark.table(target).dtypes == [
        ("id", "bigint"),
        ("amount", "decimal(18,2)"),
        ("note", "string"),
    ]
    # An existing table is left alone.
    ensure_table(spark, "made", ["other"])
    assert spark.table(target).columns == ["id", "amount", "note"]
    df = spark.range(3).selectExpr("id", "cast(id AS decimal(18,2)) AS amount", "'x' AS note")
    load_overwrite(df, target)
    load_overwrite(df.filter("id > 0"), target)
    assert read_table(spark, "made", "silver").count() == 2
    assert rows(checks.verify_target(spark, target, declared)) == [(target, "VALID", "", "", "", 2)]
    assert rows(checks.verify_target(spark, target, ["note", "id", "gone", "lost"])) == [
        (target, "INVALID", "gone, lost", "amount", "id: bigint, not string", 2)
    ]
    with pytest.raises(ValueError, match="no columns"):
        ensure_table(spark, "made_without", [])
    with pytest.raises(AnalysisException):
        read_table(spark, "no_such_table")


def test_read_table_defaults_to_the_source_schema(spark):
    ensure_table(spark, "src", ["a"], schema="bronze")
    assert read_table(spark, "src").columns == ["a"]
    assert read_table(spark, "src", "bronze", "spark_catalog").columns == ["a"]


def test_external_table(spark, tmp_path):
    place = str(tmp_path / "it's here")
    for n in (5, 2):
        target = ensure_table(spark, "placed", [("id", "BIGINT")], location=place)
        load_overwrite(spark.range(n), target)
        assert spark.table(target).count() == n
        (current,) = (tmp_path).iterdir()
        assert current.name.startswith("it's here__load_")
        assert spark.read.parquet(str(current)).count() == n
        assert described(spark, target)["type"] == "EXTERNAL"


def described(spark, target):
    return json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {target} AS JSON").first()[0])


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
@pytest.mark.parametrize("partitioned", [False, True])
@pytest.mark.parametrize("external", [False, True])
def test_an_overwrite_keeps_the_declaration(spark, tmp_path, fmt, partitioned, external):
    name = f"kept_{fmt}_{partitioned}_{external}".lower()
    place = f"LOCATION '{tmp_path}/t'" if external else ""
    by = "PARTITIONED BY (p, `q r`)" if partitioned else ""
    spark.sql(
        f"CREATE TABLE {name} (i INT, d DECIMAL(18,2), p STRING, `q r` INT) USING {fmt} {by} {place}"
    )
    try:
        data = [(1, "1.5", "a/b", 1), (2, "2", "it's", 1), (3, None, None, 2)]
        df = spark.createDataFrame(data, "i long, d string, p string, `q r` long")
        before = described(spark, name)
        for part in (df, df.filter("i > 1"), df.filter("i < 3"), df.filter("false"), df):
            # The order of columns does not matter.
            load_overwrite(part.select("p", "d", "`q r`", "I"), name)
            found = [tuple(r) for r in spark.table(name).select("i", "d", "p", "`q r`").collect()]
            expected = [(r.i, r.d and Decimal(r.d), r.p, r["q r"]) for r in part.collect()]
            assert sorted(found, key=repr) == sorted(expected, key=repr)
            if partitioned and part is df:
                assert spark.sql(f"SHOW PARTITIONS {name}").count() == 3
                assert spark.table(name).filter("p = 'it''s'").count() == 1
        after = described(spark, name)
        for key in ("columns", "provider", "type", "partition_columns"):
            assert before.get(key) == after.get(key)
        # A load that reads the table, and one that fails.
        load_overwrite(spark.table(name).filter("i = 3").union(spark.table(name)), name)
        assert spark.table(name).count() == 4
        broken = df.withColumn("d", F.expr("CASE WHEN i = 3 THEN raise_error('no') ELSE d END"))
        with pytest.raises(Exception, match="no"):
            load_overwrite(broken.repartition(3), name)
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            load_overwrite(df.withColumn("d", F.lit("x")), name)
        with pytest.raises(ValueError, match="columns"):
            load_overwrite(df.drop("d"), name)
        assert spark.table(name).count() == 4
        if external:
            assert len(list(tmp_path.iterdir())) == 1
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_targets_of_other_inputs_are_other_targets(spark):
    long = "x" * 90
    folders = [f"/a/{long}", f"/b/{long}", "/data/sf-1", "/data/sf.1", "/data/sf-1/x"]
    assert len({_target(Tables(spark, f))[0] for f in folders}) == len(folders)


def test_a_fault_in_the_summary_is_found(spark):
    tables = inputs(spark)
    good = customer_order_summary(*tables)
    wrong = good.withColumn("total_orders", F.expr("total_orders + CAST(customer_id = 1 AS INT)"))
    found = load_and_verify(wrong, expected_summary(*tables), "faulty", TARGET, "customer_id").first()
    assert (found.status, found.overall_status, found.mismatched_rows) == ("VALID", "FAIL", 1)


def inputs(spark):
    customer = spark.createDataFrame(
        [(1, " ann ", 1), (1, "Ann", 1), (2, "bob", 9), (3, "cid", 2), (4, "dan", None)],
        "c_custkey long, c_name string, c_nationkey int",
    )
    orders = spark.createDataFrame(
        [
            (10, 1, "F", 1.5, "2020-01-01"),
            (11, 1, "F", 2.25, "2020-03-01"),
            (12, 1, "O", 9.0, "2020-04-01"),
            (13, 2, "F", 0.0, "2020-01-01"),
            (14, 2, "F", 7.0, "2020-02-01"),
            (15, 4, "F", 3.0, "2020-01-01"),
            (16, 8, "F", 3.0, "2020-01-01"),
        ],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,"
        " o_orderdate string",
    ).selectExpr("* EXCEPT (o_orderdate)", "cast(o_orderdate AS timestamp_ntz) AS o_orderdate")
    nation = spark.createDataFrame(
        [(1, "N1", 1), (2, "N2", 2), (9, "N9", 7)],
        "n_nationkey int, n_name string, n_regionkey int",
    )
    region = spark.createDataFrame(
        [(1, "R1"), (1, "R1"), (2, "R2")], "r_regionkey int, r_name string"
    )
    return customer, orders, nation, region


def test_summary_with_repeated_customers_and_references(spark):
    summary = customer_order_summary(*inputs(spark))
    found = [(*r[:-1], str(r[-1])) for r in rows(summary)]
    # Both rows of customer 1 carry the same standardised name, and its region
    # occurs twice, so that each of its two orders counts four times.
    assert found == [
        (1, "ANN", "N1", "R1", 8, Decimal("15.00"), "2020-03-01"),
        (2, "BOB", "N9", None, 1, Decimal("7.00"), "2020-02-01"),
        (4, "DAN", None, None, 1, Decimal("3.00"), "2020-01-01"),
    ]
    assert rows(expected_summary(*inputs(spark))) == rows(summary)


def test_load_and_verify_finds_faults(spark):
    declared = [("k", "INT"), ("v", "VARCHAR")]
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    good = load_and_verify(df, df, "checked", declared, "k").first()
    assert (good.status, good.overall_status) == ("VALID", "PASS")
    wrong = spark.createDataFrame([(1, "a"), (3, "b")], "k int, v string")
    bad = load_and_verify(wrong, df, "checked", declared, "k").first()
    assert (bad.status, bad.overall_status, bad.missing_rows, bad.extra_rows) == (
        "VALID",
        "FAIL",
        1,
        1,
    )


class Statements:
    """The statements that a load runs; the one that holds ``bad`` fails."""

    def __init__(self, spark, monkeypatch, bad=None):
        self.seen, plain = [], spark.sql

        def sql(text, *args, **more):
            if text.startswith("ALTER"):
                self.seen.append(text)
                if bad and bad in text and "PARTITION" in text:
                    raise RuntimeError("no")
            return plain(text, *args, **more)

        monkeypatch.setattr(spark, "sql", sql, raising=False)


def test_all_partitions_change_by_one_statement(spark, monkeypatch):
    declared = [("i", "INT"), ("p", "VARCHAR"), ("q", "INT")]
    target = ensure_table(spark, "switched", declared, None, partitioned_by=["p", "q"])
    try:
        data = [(1, "a/b", 1), (2, "it's", 2), (3, None, 2), (4, "z", None)]
        df = spark.createDataFrame(data, "i int, p string, q int")
        for part in (df, df.filter("i > 2"), df.filter("false"), df):
            with monkeypatch.context() as patch:
                run = Statements(spark, patch)
                load_overwrite(part, target)
                assert len(run.seen) == 1 and "SET LOCATION" in run.seen[0]
            assert sorted(map(tuple, spark.table(target).collect())) == sorted(map(tuple, part.collect()))
        assert spark.table(target).filter("p = 'it''s' AND q = 2").count() == 1
    finally:
        spark.sql(f"DROP TABLE {target}")


@pytest.mark.parametrize("bad", ["ADD", "SET LOCATION", "DROP"])
def test_a_change_of_partitions_that_fails_is_undone(spark, monkeypatch, bad):
    """Where the catalog holds each partition, and a statement on partitions fails."""
    spark.sql("CREATE TABLE undone (i INT, p STRING) USING parquet PARTITIONED BY (p)")
    try:
        first = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "i int, p string")
        second = spark.createDataFrame([(4, "a"), (5, "b"), (6, "d"), (7, "e")], "i int, p string")
        for given in (first, second):  # once from the table's own folders, once from those of a load
            load_overwrite(given, "undone")
            other = second if given is first else first
            with monkeypatch.context() as patch:
                Statements(spark, patch, bad)
                with pytest.raises(RuntimeError, match="no"):
                    load_overwrite(other, "undone")
            assert sorted(map(tuple, spark.table("undone").collect())) == sorted(map(tuple, given.collect()))
            load_overwrite(other, "undone")
            assert sorted(map(tuple, spark.table("undone").collect())) == sorted(map(tuple, other.collect()))
    finally:
        spark.sql("DROP TABLE undone")


def test_a_load_counts_what_it_writes(spark):
    declared = [("k", "INT"), ("d", "DATE"), ("n", "DECIMAL", 4, 1)]
    df = spark.createDataFrame(
        [(1, "2024-01-01", "1.5"), (2, "x", "y"), (3, None, "12345.6"), (4, "2024-02-30", None)], "k int, d string, n string"
    )
    expected = spark.createDataFrame([(1, None, None)], "k int, d date, n decimal(4,1)")
    for part, counts in ((df, (4, 4)), (df.filter("k = 1"), (1, 0)), (df.filter("k > 9"), (0, 0)), (df.filter("false"), (0, 0))):
        found = load_and_verify(part, expected, "counted", declared, "k", schema=None, on_error="null").first()
        assert (found.loaded_rows, found.failed_casts) == counts
        assert found.actual_row_count == counts[0]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        load_and_verify(df, expected, "counted", declared, "k", schema=None)
    found = load_and_verify(df.filter("k = 1"), expected, "counted", declared, "k", schema=None).first()
    assert (found.loaded_rows, found.failed_casts) == (1, 0)
    spark.sql("DROP TABLE counted")
