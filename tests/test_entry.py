"""The driver contract, and agreement of hot joins with plain ones on random tables."""

import random

import pytest

import __spark_entry__ as contract
from tablewright.operators.joins import join
from tablewright.plans.queries import ORACLES, QUERIES


def test_entry(spark):
    df = contract.entry(spark)
    assert df.dtypes == [
        ("customer_id", "bigint"),
        ("customer_name", "string"),
        ("country_name", "string"),
        ("region", "string"),
        ("total_orders", "int"),
        ("total_amount", "decimal(18,2)"),
        ("last_order_date", "date"),
    ]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    """But for those of the training-data subpackage, which is not part of the rest."""
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= contract.queries().keys()
    assert ORACLES.keys() <= contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("seed", range(3))
def test_hot_joins_agree_with_plain_ones(spark, seed):
    rng = random.Random(seed)

    def table(name):
        data = [
            (rng.choice([None, 1, 1, 1, 2, 3, 4, 5]), rng.choice([None, "a", "b"]), i)
            for i in range(rng.randrange(30))
        ]
        return spark.createDataFrame(data, f"k int, s string, {name} int")

    left, right = table("v"), table("w")
    on = [("k", "k"), ("s", "s")]
    for how in ("INNER", "LEFT", "RIGHT", "FULL"):
        sides = (None, "left", "right", "both")
        joined = (join(left, right, on, how, ["v", "w"], side) for side in sides)
        plain, *hot = (sorted((tuple(r) for r in df.collect()), key=repr) for df in joined)
        assert all(h == plain for h in hot)
