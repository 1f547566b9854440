"""Customer order summary: one row per customer with completed orders.

Names are standardised, completed orders with a positive amount counted and summed
per customer, and the customer's country and region looked up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions import Declared, standardize_name
from tablewright.operators.aggregates import summarize
from tablewright.operators.columns import conform, derive, map_columns, source_view
from tablewright.operators.joins import join, lookup
from tablewright.operators.rows import keep

TARGET = [
    Declared("customer_id", "BIGINT"),
    Declared("customer_name", "VARCHAR"),
    Declared("country_name", "VARCHAR"),
    Declared("region", "VARCHAR"),
    Declared("total_orders", "INTEGER"),
    Declared("total_amount", "DECIMAL", 18, 2),
    Declared("last_order_date", "DATE"),
]
KEYS = ["customer_id"]


def customer_order_summary(
    customer: DataFrame, orders: DataFrame, nation: DataFrame, region: DataFrame
) -> DataFrame:
    """The summary, in the columns and types of ``TARGET``.

    Orders are summed per customer before the join. That sends one partial row per
    customer and task through the shuffle however many orders a customer has, leaves
    nothing skewed for the join, and the final grouping, which merges customers that
    the inputs hold more than once, reuses the partitioning of the join.
    """
    completed = keep(orders, "o_orderstatus = 'F' AND o_totalprice > 0").transform(
        derive, [("amount", "cast(o_totalprice AS decimal(18,2))")]
    )
    per_customer = summarize(
        completed,
        "o_custkey",
        [
            ("orders", F.count("o_orderkey")),
            ("amount", F.sum("amount")),
            ("last_order", F.max("o_orderdate")),
        ],
    )
    customers = source_view(customer, ["c_custkey", "c_name", "c_nationkey"]).transform(
        derive, [("c_name", standardize_name("c_name"))]
    )
    located = (
        join(customers, per_customer, ("c_custkey", "o_custkey"))
        .transform(
            lookup,
            nation,
            ("c_nationkey", "n_nationkey"),
            [("n_name", "country_name"), "n_regionkey"],
        )
        .transform(lookup, region, ("n_regionkey", "r_regionkey"), [("r_name", "region")])
    )
    summed = summarize(
        located,
        "c_custkey, c_name, country_name, region",
        [
            ("orders", F.sum("orders")),
            ("amount", F.sum("amount")),
            ("last_order", F.max("last_order")),
        ],
    )
    links = [
        ("c_custkey", "customer_id"),
        ("c_name", "customer_name"),
        ("country_name", None),
        ("region", None),
        ("orders", "total_orders"),
        ("amount", "total_amount"),
        ("last_order", "last_order_date"),
    ]
    return map_columns(summed, links).transform(conform, TARGET)


def expected_summary(
    customer: DataFrame, orders: DataFrame, nation: DataFrame, region: DataFrame
) -> DataFrame:
    """The same result by another way, to reconcile a load with: every order joined, then grouped."""
    return customer.sparkSession.sql(
        """
        SELECT c.c_custkey AS customer_id,
               upper(trim(c.c_name)) AS customer_name,
               n.n_name AS country_name,
               r.r_name AS region,
               cast(count(o.o_orderkey) AS int) AS total_orders,
               cast(sum(cast(o.o_totalprice AS decimal(18,2))) AS decimal(18,2)) AS total_amount,
               cast(max(o.o_orderdate) AS date) AS last_order_date
        FROM {customer} c
        JOIN {orders} o ON o.o_custkey = c.c_custkey
        LEFT JOIN {nation} n ON n.n_nationkey = c.c_nationkey
        LEFT JOIN {region} r ON r.r_regionkey = n.n_regionkey
        WHERE o.o_orderstatus = 'F' AND o.o_totalprice > 0
        GROUP BY c.c_custkey, upper(trim(c.c_name)), n.n_name, r.r_name
        """,
        customer=customer,
        orders=orders,
        nation=nation,
        region=region,
    )
