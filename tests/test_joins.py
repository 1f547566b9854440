from itertools import product

import pytest
from pyspark.sql import functions as F

from tablewright.operators import joins
from tablewright.operators.checks import references
from tablewright.operators.joins import join, join_type, lookup
from tablewright.operators.rows import keep


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def left(spark):
    data = [(1, "a"), (1, "b"), (2, "c"), (None, "d"), (4, "e")]
    return spark.createDataFrame(data, "k int, v string")


@pytest.fixture(scope="module")
def right(spark):
    data = [(1, "p"), (1, "q"), (2, "r"), (None, "s"), (5, "t")]
    return spark.createDataFrame(data, "k bigint, w string")


OUT = [("left", "k", "lk"), "v", ("right", "k", "rk"), "w"]
MATCHED = [
    (1, "a", 1, "p"),
    (1, "a", 1, "q"),
    (1, "b", 1, "p"),
    (1, "b", 1, "q"),
    (2, "c", 2, "r"),
]
LEFT_ONLY = [(4, "e", None, None), (None, "d", None, None)]
RIGHT_ONLY = [(None, None, 5, "t"), (None, None, None, "s")]


@pytest.mark.parametrize(
    "how, kind",
    [
        (None, "inner"),
        ("normal join", "inner"),
        ("CONNECTED", "inner"),
        ("INNER JOIN", "inner"),
        ("LEFTOUTER", "left"),
        ("rightouter", "right"),
        ("FullOuter", "full"),
        ("LEFT OUTER JOIN", "left"),
        ("LEFTSEMI", "left_semi"),
        ("LEFTANTI", "left_anti"),
        ("Master", "left"),
        ("detail", "left"),
        ("left_outer", "left"),
        ("RIGHT OUTER", "right"),
        ("outer", "full"),
        ("full  outer", "full"),
        ("cross", "inner"),
        ("LEFT_SEMI", "left_semi"),
        ("left anti", "left_anti"),
    ],
)
def test_join_type(how, kind):
    assert join_type(how) == kind


def test_unknown_join_type_is_an_error():
    with pytest.raises(ValueError, match="MASTER OUTER"):
        join_type("MASTER OUTER")


@pytest.mark.parametrize("hot", [None, "left", "right", "both"])
@pytest.mark.parametrize(
    "how, expected",
    [
        ("INNER", MATCHED),
        ("CROSS", MATCHED),
        ("LEFT", MATCHED + LEFT_ONLY),
        ("RIGHT", MATCHED + RIGHT_ONLY),
        ("FULL", MATCHED + LEFT_ONLY + RIGHT_ONLY),
    ],
)
def test_join_kinds(left, right, how, expected, hot):
    joined = join(left, right, ("k", "k"), how, OUT, hot)
    assert joined.columns == ["lk", "v", "rk", "w"]
    assert joined.dtypes == [("lk", "int"), ("v", "string"), ("rk", "bigint"), ("w", "string")]
    assert rows(joined) == sorted(expected, key=repr)


@pytest.mark.parametrize("hot", [None, "both"])
def test_semi_and_anti(left, right, hot):
    assert rows(join(left, right, ("k", "k"), "LEFT_SEMI", hot=hot)) == [
        (1, "a"),
        (1, "b"),
        (2, "c"),
    ]
    assert rows(join(left, right, ("k", "k"), "LEFT_ANTI", ["v"], hot)) == [("d",), ("e",)]


@pytest.mark.parametrize("hot", ["left", "right", "both"])
def test_hot_outer_join_that_keeps_columns_of_one_side_only(left, right, hot):
    for how, kept in product(("LEFT", "RIGHT", "FULL"), (["v"], ["w"])):
        plain = join(left, right, ("k", "k"), how, kept)
        assert rows(join(left, right, ("k", "k"), how, kept, hot)) == rows(plain)


@pytest.mark.parametrize("how", ["INNER", "LEFT", "RIGHT", "FULL", "LEFT_SEMI", "LEFT_ANTI"])
@pytest.mark.parametrize("kinds", [("string", "string"), ("string", "int"), ("double", "double")])
def test_hot_keys_of_other_types(spark, how, kinds):
    a = spark.createDataFrame([("1", 1), ("2", 2), (None, 3)], "k string, v int")
    b = spark.createDataFrame([("2", 4), ("3", 5), (None, 6)], "k string, w int")
    a, b = (df.withColumn("k", F.col("k").cast(t)) for df, t in zip((a, b), kinds))
    kept = ["v"] if "_" in how else ["v", "w"]
    native = a.alias("a").join(b.alias("b"), F.col("a.k") == F.col("b.k"), how.lower())
    assert rows(join(a, b, ("k", "k"), how, kept, "both")) == rows(native.select(kept))


def test_composite_keys(spark):
    a = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (2, "x", 3)], "i int, s string, v int")
    b = spark.createDataFrame([(1, "y", 4), (2, "x", 5), (2, "y", 6)], "j int, t string, w int")
    joined = join(a, b, [("i", "j"), ("s", "t")], select=["v", "w"])
    assert rows(joined) == [(2, 4), (3, 5)]


def test_condition_text_and_column_name_the_sides(left, right):
    text = "left.k = right.k\nAND left.v < 'b'"
    column = (F.col("left.k") == F.col("right.k")) & (F.col("left.v") < "b")
    for on in (text, column):
        assert rows(join(left, right, on, "INNER", OUT)) == MATCHED[:2]
    assert rows(join(left, right, "left.k > right.k", "INNER", OUT, all_pairs=True)) == [
        (2, "c", 1, "p"),
        (2, "c", 1, "q"),
        (4, "e", 1, "p"),
        (4, "e", 1, "q"),
        (4, "e", 2, "r"),
    ]


def test_condition_text_may_use_other_names_for_the_sides(left, right):
    text = "CUST.k = ORD.k AND CUST.v < 'b'"
    assert rows(join(left, right, text, "INNER", OUT, names=("CUST", "ORD"))) == MATCHED[:2]
    found = lookup(left, right, "c.k = o.k AND o.w > 'p'", ["w"], names=("c", "o"))
    assert rows(found) == [
        (1, "a", "q"),
        (1, "b", "q"),
        (2, "c", "r"),
        (4, "e", None),
        (None, "d", None),
    ]


def test_output_names(left, right):
    with pytest.raises(ValueError, match="more than once"):
        join(left, right, ("k", "k"))
    with pytest.raises(ValueError, match="more than once"):
        join(left, right, ("k", "k"), select=["v", ("w", "V")])
    with pytest.raises(ValueError, match="neither"):
        join(left, right, ("k", "k"), select=["nope"])
    with pytest.raises(ValueError, match="neither"):
        join(left, right, ("k", "k"), select=[("right", "v", "x")])
    # A name both sides have is taken from the left.
    assert rows(join(left, right, ("k", "k"), "RIGHT", ["k", "w"]))[-2:] == [
        (None, "s"),
        (None, "t"),
    ]


@pytest.mark.parametrize("on", [None, "", " ", [], ()])
def test_missing_condition_is_an_error(left, right, on):
    for how in ("INNER", "CROSS"):
        with pytest.raises(ValueError, match="no condition"):
            join(left, right, on, how, OUT)


@pytest.mark.parametrize("how", ["INNER", "LEFT", "FULL", "LEFT ANTI"])
def test_conditions_without_an_equality_need_consent(left, right, how):
    out = ["v"] if how == "LEFT ANTI" else OUT
    for on in ("left.k > right.k", "left.k = 1 AND right.k = 1", "left.k = right.k OR left.k = 2"):
        for condition in (on, F.expr(on)):
            with pytest.raises(ValueError, match="all_pairs"):
                join(left, right, condition, how, out)
        join(left, right, on, how, out, all_pairs=True)
    join(left, right, "(left.k = right.k AND left.v < 'b') OR left.k = right.k", how, out)
    join(left, right, "left.k + 1 = right.k -- next\nAND left.v > 'a'", how, out)


def test_comments_and_newlines_of_conditions_are_kept(left, right):
    on = "left.k = right.k -- the key\nAND left.v < 'b'"
    assert rows(join(left, right, on, "INNER", OUT)) == MATCHED[:2]
    df = left.sparkSession.createDataFrame([(1, "a\nb"), (3, "a b")], "id int, s string")
    assert rows(keep(df, "id > 0 -- all\nAND s = 'a b'")) == [(3, "a b")]
    assert rows(keep(df, "s = 'a\nb'")) == [(1, "a\nb")]
    other = df.withColumnRenamed("id", "j")
    assert rows(join(df, other, "left.s = right.s AND left.s = 'a\nb'", select=["id", "j"])) == [(1, 1)]


def test_lists_of_plain_names_are_refused(left, right):
    for on in (["k", "v"], ["k"], [("k", "k", "k")]):
        with pytest.raises(ValueError, match="pairs"):
            join(left, right, on, select=OUT)


def test_colocated_tables_are_joined_where_they_are(spark):
    df = spark.range(1000).selectExpr("id AS k", "id % 7 AS v")
    for name in ("colocated_one", "colocated_two"):
        df.write.bucketBy(4, "k").mode("overwrite").saveAsTable(name)
    one, two = spark.table("colocated_one"), spark.table("colocated_two").filter("v = 1")
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        found = [
            join(one, two, ("k", "k"), "LEFT SEMI", colocated=True),
            join(one, two, ("k", "k"), "LEFT ANTI", colocated=True),
            references(one, two, ("k", "k"), colocated=True),
        ]
        for df in found:
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        assert [df.count() for df in found] == [143, 857, 857]
        assert join(one, two, ("k", "k"), "LEFT SEMI").count() == 143
    finally:
        spark.conf.set(key, before)


def test_hot_full_join_of_odd_field_names(spark):
    df = spark.sql("SELECT id AS k, named_struct('a-b', id) AS s FROM range(3)")
    other = df.selectExpr("k + 1 AS j", "s AS u")
    assert join(df, other, ("k", "j"), "FULL", ["s", "u"], hot="both").count() == 4


def test_bad_arguments(left, right):
    with pytest.raises(ValueError, match="absent from the right"):
        join(left, right, ("k", "nope"), select=OUT)
    with pytest.raises(ValueError, match="hot must be"):
        join(left, right, ("k", "k"), select=OUT, hot="middle")
    with pytest.raises(ValueError, match="key pairs"):
        join(left, right, "left.k = right.k", select=OUT, hot="left")


@pytest.mark.parametrize("hot", [None, "left", "right", "both"])
def test_lookup_returns_every_match(left, right, hot):
    found = lookup(left, right, ("k", "k"), ["w", ("k", "ref_k")], hot=hot)
    assert found.columns == ["k", "v", "w", "ref_k"]
    assert rows(found) == sorted(
        [(k, v, w, r) for k, v, r, w in MATCHED + LEFT_ONLY], key=repr
    )
    inner = lookup(left, right, [("k", "k")], ["w"], how="INNER", hot=hot)
    assert rows(inner) == [(k, v, w) for k, v, _, w in MATCHED]


def test_lookup_errors(left, right):
    with pytest.raises(ValueError, match="no column"):
        lookup(left, right, ("k", "k"), [])
    with pytest.raises(ValueError, match="more than once"):
        lookup(left, right, ("k", "k"), ["k"])


def test_lookup_on_a_table_derived_from_the_same_one(left):
    counts = left.groupBy("k").agg(F.count("*").alias("n"))
    assert rows(lookup(left, counts, ("k", "k"), ["n"], hot="left")) == [
        (1, "a", 2),
        (1, "b", 2),
        (2, "c", 1),
        (4, "e", 1),
        (None, "d", None),
    ]


@pytest.fixture
def tiny_partitions(spark):
    """Thresholds under which a few hundred kilobytes count as a skewed partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def executed_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]


@pytest.mark.parametrize("how", ["INNER", "LEFT", "FULL", "LEFT_SEMI", "LEFT_ANTI"])
def test_hot_key_is_split(spark, tiny_partitions, how):
    key = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id"))
    facts = spark.range(0, 200_000, 1, 16).select(key.alias("k"), F.col("id").alias("v"))
    counts = facts.groupBy("k").agg(F.count("*").alias("n"))
    kept = ["v"] if "_" in how else ["v", "n"]

    def splits(hot):
        return executed_plan(join(facts, counts, ("k", "k"), how, kept, hot)).count("skew=true")

    assert splits("left") > 0
    if "_" not in how:
        assert splits(None) == 0, "the grouped side enters the join without an exchange"


@pytest.mark.parametrize("how, hot", [("FULL", None), ("LEFT", "auto"), ("RIGHT", "auto"), ("INNER", "auto")])
def test_hot_keys_are_found(spark, tiny_partitions, monkeypatch, how, hot):
    """Nobody says which side is hot: a third of the facts have one key."""
    monkeypatch.setattr(joins, "HOT_ROWS", 10_000)
    key = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id"))
    facts = spark.range(0, 100_000, 1, 16).select(key.alias("k"), F.col("id").alias("v"))
    some = spark.range(-1, 50_000).selectExpr("id AS k", "id + 1 AS n")
    sides = (some, facts) if how == "LEFT" else (facts, some)
    found = join(*sides, ("k", "k"), how, ["v", "n"], hot)
    assert executed_plan(found).count("skew=true") > 0
    plain = join(*sides, ("k", "k"), how, ["v", "n"], "none")
    if how != "INNER":  # which adaptive execution splits as it is
        assert executed_plan(plain).count("skew=true") == 0
    total = ("count(*)", "sum(v)", "sum(n)")
    assert found.selectExpr(*total).first() == plain.selectExpr(*total).first()


def test_no_key_is_hot(spark, monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", 3)
    a = spark.createDataFrame([(None, i) for i in range(30)] + [(i, i) for i in range(9)], "k int, v int")
    for df, hot in ((a, None), (a.filter("false"), None), (a.union(a.filter("k = 1")).union(a.filter("k = 1")), "left")):
        pairs = [("k", "k")]
        # The default of 8 partitions makes two fair shares of 9 to 11 keys less than 3 rows.
        assert joins._hot_sides(df, a, pairs, "full") == hot


@pytest.mark.parametrize("how, shared", [("LEFT", 1), ("RIGHT", 1), ("FULL", 2)])
def test_outer_join_in_parts_shuffles_each_side_once(spark, tiny_partitions, how, shared):
    a = spark.range(1000).selectExpr("id % 700 AS k", "id AS v")
    b = spark.range(1000).selectExpr("id % 500 + 300 AS k", "id AS w")
    plan = executed_plan(join(a, b, ("k", "k"), how, ["v", "w"], "both"))
    assert plan.count("ReusedExchange") == shared
