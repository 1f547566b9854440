"""Queries over the test tables, each with the SQL that states its result.

Every query reads its tables whole. Computed columns have the same names and types
on both sides; money is DECIMAL, averages of doubles are rounded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions import standardize_name
from tablewright.operators import checks, reconcile
from tablewright.operators.aggregates import quantiles, summarize
from tablewright.operators.columns import cast_failures, conform, derive, map_columns, source_view
from tablewright.operators.joins import join, lookup
from tablewright.operators.ranges import range_join
from tablewright.operators.rows import keep
from tablewright.plans import customer_orders
from tablewright.plans.load import load_and_verify
from tablewright.sources.tables import ensure_table, load_overwrite, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables of one directory as attributes: ``t.orders``."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        df = read_table(self.spark, f"{self.directory}/{name}.parquet", schema="parquet")
        setattr(self, name, df)
        return df


def query(sql: str):
    """Register a function from ``Tables`` to a DataFrame together with its SQL."""

    def register(build: Callable[[Tables], DataFrame]):
        name = build.__name__.rstrip("_")
        QUERIES[name] = lambda spark, directory: build(Tables(spark, directory))
        ORACLES[name] = sql
        return build

    return register


# Sources and target shaping


@query("SELECT * FROM orders")
def read_table_(t):
    return t.orders


@query("SELECT p_partkey, p_name, p_brand FROM part")
def source_view_(t):
    return source_view(t.part, ["p_partkey", "p_name", "p_brand"])


@query(
    """
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date
    FROM orders
    """
)
def map_columns_(t):
    links = [
        ("o_orderkey", "order_id"),
        ("o_custkey", "customer_id"),
        ("o_orderdate", "order_date"),
    ]
    return map_columns(t.orders, links)


@query(
    """
    SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey,
           CAST(o_custkey AS INTEGER) AS o_custkey,
           CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice,
           CAST(o_orderdate AS DATE) AS o_orderdate,
           CAST(priority_no AS SMALLINT) AS priority_no,
           CAST(is_open AS BOOLEAN) AS is_open
    FROM (SELECT *, substr(o_orderpriority, 1, 1) AS priority_no,
                 CASE WHEN o_orderstatus = 'O' THEN 'true' ELSE 'false' END AS is_open
          FROM orders)
    """
)
def conform_types(t):
    texts = derive(
        t.orders,
        [
            ("priority_no", "substr(o_orderpriority, 1, 1)"),
            ("is_open", "CASE WHEN o_orderstatus = 'O' THEN 'true' ELSE 'false' END"),
        ],
    )
    declared = [
        ("o_orderkey", "bigint"),
        ("o_custkey", "Integer"),
        ("o_totalprice", "NUMERIC"),
        ("o_orderdate", "DATE"),
        ("priority_no", "SMALLINT"),
        ("is_open", "BOOL"),
    ]
    return conform(texts, declared)


@query(
    """
    SELECT 'o_orderpriority' AS column_name,
           count_if(TRY_CAST(o_orderpriority AS INTEGER) IS NULL)::BIGINT AS failed_rows
    FROM orders
    UNION ALL SELECT 'o_orderdate', count_if(TRY_CAST(o_orderdate AS DATE) IS NULL)::BIGINT
    FROM orders
    """
)
def conform_failures(t):
    return cast_failures(t.orders, [("o_orderpriority", "INT"), ("o_orderdate", "DATE")])


# Scalar expressions and filters


@query(
    """
    SELECT *, CAST(net_price * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS tax_amount
    FROM (SELECT l_orderkey, l_linenumber, l_tax,
                 CAST(CAST(l_extendedprice AS DECIMAL(12,2))
                      * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(12,2)) AS net_price
          FROM lineitem)
    """
)
def derive_columns(t):
    priced = derive(
        t.lineitem,
        [
            (
                "net_price",
                """cast(cast(l_extendedprice AS decimal(12,2))
                        * (1 - cast(l_discount AS decimal(4,2))) AS decimal(12,2))""",
            ),
            ("tax_amount", "cast(net_price * cast(l_tax AS decimal(4,2)) AS decimal(18,4))"),
        ],
    )
    return source_view(priced, ["l_orderkey", "l_linenumber", "l_tax", "net_price", "tax_amount"])


def _padded_names(t):
    padded = F.lower(F.concat(F.lit("  "), "c_name", F.lit(" ")))
    return derive(source_view(t.customer, ["c_custkey", "c_name"]), [("padded", padded)])


_PADDED = """
    (SELECT c_custkey, c_name, lower(concat('  ', c_name, ' ')) AS padded FROM customer)
"""


@query(f"SELECT c_custkey, upper(padded) AS name FROM {_PADDED}")
def str_upper(t):
    return derive(_padded_names(t), [("name", F.upper("padded"))]).select("c_custkey", "name")


@query("SELECT c_custkey, lower(c_name) AS name FROM customer")
def str_lower(t):
    return derive(t.customer, [("name", "lower(c_name)")]).select("c_custkey", "name")


@query(f"SELECT c_custkey, trim(padded) AS name FROM {_PADDED}")
def str_trim(t):
    return derive(_padded_names(t), [("name", F.trim("padded"))]).select("c_custkey", "name")


@query(f"SELECT c_custkey, upper(trim(padded)) AS name FROM {_PADDED}")
def str_upper_trim(t):
    named = derive(_padded_names(t), [("name", standardize_name("padded"))])
    return named.select("c_custkey", "name")


@query(
    """
    SELECT l_orderkey, l_linenumber,
           CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2))
                AS DECIMAL(18,4)) AS discount_amount
    FROM lineitem
    """
)
def expr_arithmetic(t):
    amount = """cast(cast(l_extendedprice AS decimal(12,2)) * cast(l_discount AS decimal(4,2))
                     AS decimal(18,4))"""
    derived = derive(t.lineitem, [("discount_amount", amount)])
    return derived.select("l_orderkey", "l_linenumber", "discount_amount")


@query(
    """
    SELECT o_orderkey,
           CASE WHEN o_totalprice < 100000 THEN 'low' WHEN o_totalprice < 300000 THEN 'middle'
                ELSE 'high' END AS price_band
    FROM orders
    """
)
def expr_case(t):
    band = """CASE WHEN o_totalprice < 100000 THEN 'low'
                   WHEN o_totalprice < 300000 THEN 'middle' ELSE 'high' END"""
    return derive(t.orders, [("price_band", band)]).select("o_orderkey", "price_band")


@query(
    """
    SELECT d.doc_id, coalesce(l.quality, -1) AS quality,
           concat(d.lang, '/', coalesce(CAST(l.toxic AS VARCHAR), 'unknown')) AS tag
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
    """
)
def expr_coalesce(t):
    labelled = lookup(
        source_view(t.documents, ["doc_id", "lang"]),
        t.labels,
        ("doc_id", "doc_id"),
        ["quality", "toxic"],
    )
    filled = derive(
        labelled,
        [
            ("quality", "coalesce(quality, -1)"),
            ("tag", "concat(lang, '/', coalesce(cast(toxic AS string), 'unknown'))"),
        ],
    )
    return filled.select("doc_id", "quality", "tag")


@query(
    """
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS order_year,
           CAST(month(o_orderdate) AS INTEGER) AS order_month,
           CAST(o_orderdate AS DATE) AS order_day
    FROM orders
    """
)
def expr_date(t):
    dated = derive(
        t.orders,
        [
            ("order_year", "year(o_orderdate)"),
            ("order_month", "month(o_orderdate)"),
            ("order_day", "cast(o_orderdate AS date)"),
        ],
    )
    return dated.select("o_orderkey", "order_year", "order_month", "order_day")


@query(
    """
    SELECT o_orderkey, o_orderstatus, o_totalprice
    FROM orders
    WHERE o_orderstatus = 'F' AND nullif(o_orderpriority, '5-LOW') < '4'
    """
)
def filter_rows(t):
    # The second condition is NULL for low priorities.
    closed = "o_orderstatus = 'F' -- the closed ones"
    kept = keep(t.orders, f"{closed}\nAND nullif(o_orderpriority, '5-LOW') < '4'")
    return source_view(kept, ["o_orderkey", "o_orderstatus", "o_totalprice"])


# Joins and lookups. Both inputs of the outer customer-order joins hold unmatched keys.


def _customers(t):
    return keep(t.customer, "c_mktsegment <> 'BUILDING'")


def _closed_orders(t):
    return keep(t.orders, "o_orderstatus = 'F'")


_CUSTOMER_ORDER = ["c_custkey", "c_name", "o_orderkey", "o_custkey"]


def _customer_order_sql(kind: str) -> str:
    return f"""
        SELECT c_custkey, c_name, o_orderkey, o_custkey
        FROM (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') c
        {kind} JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F') o ON c_custkey = o_custkey
    """


@query(
    """
    SELECT c_custkey, c_name, o_orderkey, o_custkey
    FROM customer INNER JOIN orders ON c_custkey = o_custkey
    """
)
def join_inner(t):
    return join(t.customer, t.orders, ("c_custkey", "o_custkey"), "NORMAL JOIN", _CUSTOMER_ORDER)


@query(_customer_order_sql("LEFT"))
def join_left(t):
    on = ("c_custkey", "o_custkey")
    return join(_customers(t), _closed_orders(t), on, "LEFT", _CUSTOMER_ORDER, hot="right")


@query(_customer_order_sql("RIGHT"))
def join_right(t):
    on = ("c_custkey", "o_custkey")
    return join(_customers(t), _closed_orders(t), on, "RIGHT OUTER", _CUSTOMER_ORDER)


@query(_customer_order_sql("FULL"))
def join_full(t):
    on = ("c_custkey", "o_custkey")
    return join(_customers(t), _closed_orders(t), on, "FULL OUTER", _CUSTOMER_ORDER, hot="both")


@query(
    """
    SELECT s_suppkey, s_name, n_name
    FROM supplier CROSS JOIN nation
    WHERE s_nationkey = n_nationkey AND s_acctbal > n_regionkey * 1000
    """
)
def join_cross(t):
    condition = "left.s_nationkey = right.n_nationkey AND left.s_acctbal > right.n_regionkey * 1000"
    return join(t.supplier, t.nation, condition, "CROSS", ["s_suppkey", "s_name", "n_name"])


@query(
    """
    SELECT doc_id, lang, n_chars FROM documents d
    WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
    """
)
def join_semi(t):
    kept = ["doc_id", "lang", "n_chars"]
    return join(t.documents, t.labels, ("doc_id", "doc_id"), "LEFT_SEMI", kept)


@query(
    """
    SELECT doc_id, lang, n_chars FROM documents d
    WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
    """
)
def join_anti(t):
    kept = ["doc_id", "lang", "n_chars"]
    return join(t.documents, t.labels, ("doc_id", "doc_id"), "LEFT_ANTI", kept)


@query(
    """
    SELECT l_orderkey, l_linenumber, l_shipdate, o_orderdate
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND l_shipdate < o_orderdate
    """
)
def join_theta(t):
    condition = "left.l_orderkey = right.o_orderkey AND left.l_shipdate < right.o_orderdate"
    kept = ["l_orderkey", "l_linenumber", "l_shipdate", "o_orderdate"]
    return join(t.lineitem, t.orders, condition, "INNER", kept)


_NEAR_SQL = """
    SELECT s_suppkey, s_acctbal, c_custkey, c_acctbal
    FROM supplier {kind} JOIN customer
      ON s_acctbal - {below} <= c_acctbal AND c_acctbal < s_acctbal + {above}
"""


def _near(t, how: str, below: float, above: float, select):
    """Suppliers with the customers whose balance is near theirs."""
    ends = [("low", f"s_acctbal - {below}D"), ("high", f"s_acctbal + {above}D")]
    supplier = derive(source_view(t.supplier, ["s_suppkey", "s_acctbal"]), ends)
    return range_join(supplier, t.customer, ("right", "c_acctbal"), ("low", "high"), how, select)


_NEAR = ["s_suppkey", "s_acctbal", "c_custkey", "c_acctbal"]


@query(_NEAR_SQL.format(kind="INNER", below=20, above=20.5))
def join_range(t):
    return _near(t, "INNER", 20, 20.5, _NEAR)


@query(_NEAR_SQL.format(kind="LEFT", below=0.5, above=2.25))
def join_range_left(t):
    return _near(t, "LEFT", 0.5, 2.25, _NEAR)


@query(_NEAR_SQL.format(kind="FULL", below=0.25, above=1))
def join_range_full(t):
    return _near(t, "FULL", 0.25, 1, _NEAR)


@query(
    """
    SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey % 40 = l_suppkey % 40
                      AND o_orderdate <= l_shipdate AND l_shipdate < o_orderdate + INTERVAL 3 DAY)
    """
)
def join_range_anti(t):
    """Lines shipped in no three days after an order of their slot; slots must be equal besides."""
    lines = derive(t.lineitem, [("slot", "l_suppkey % 40")])
    spans = t.orders.selectExpr(
        "o_custkey % 40 AS slot", "o_orderdate AS since", "o_orderdate + INTERVAL 3 DAY AS until"
    )
    kept = ["l_orderkey", "l_linenumber", "l_shipdate"]
    return range_join(lines, spans, ("left", "l_shipdate"), ("since", "until"), "ANTI", kept, ("slot", "slot"))


@query(
    """
    SELECT a.l_partkey AS part_id, a.l_suppkey AS supplier_id, a.quantity, r.returned
    FROM (SELECT l_partkey, l_suppkey,
                 CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS quantity
          FROM lineitem GROUP BY l_partkey, l_suppkey) a
    JOIN (SELECT l_partkey, l_suppkey,
                 CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS returned
          FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_partkey, l_suppkey) r
      ON a.l_partkey = r.l_partkey AND a.l_suppkey = r.l_suppkey
    """
)
def join_composite(t):
    total = "cast(sum(cast(l_quantity AS decimal(12,2))) AS decimal(18,2))"
    keys = ["l_partkey", "l_suppkey"]
    shipped = summarize(t.lineitem, keys, [("quantity", total)])
    returned = summarize(keep(t.lineitem, "l_returnflag = 'R'"), keys, [("returned", total)])
    outputs = [
        ("left", "l_partkey", "part_id"),
        ("left", "l_suppkey", "supplier_id"),
        "quantity",
        "returned",
    ]
    return join(shipped, returned, [(k, k) for k in keys], "INNER", outputs)


@query(
    """
    SELECT c_custkey AS customer_id, c_name, o_orderkey AS order_id, o_totalprice
    FROM customer JOIN orders ON c_custkey = o_custkey
    """
)
def join_select(t):
    outputs = [
        ("c_custkey", "customer_id"),
        "c_name",
        ("right", "o_orderkey", "order_id"),
        "o_totalprice",
    ]
    return join(t.customer, t.orders, ("c_custkey", "o_custkey"), "CONNECTED", outputs)


@query(
    """
    SELECT d.doc_id, d.lang, d.n_chars, l.quality, l.toxic AS is_toxic
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
    """
)
def lookup_left(t):
    documents = source_view(t.documents, ["doc_id", "lang", "n_chars"])
    return lookup(documents, t.labels, ("doc_id", "doc_id"), ["quality", ("toxic", "is_toxic")])


@query(
    """
    SELECT c_custkey, c_name, o_orderkey, o_totalprice
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey
    """
)
def lookup_fanout(t):
    customers = source_view(t.customer, ["c_custkey", "c_name"])
    added = ["o_orderkey", "o_totalprice"]
    return lookup(customers, t.orders, ("c_custkey", "o_custkey"), added, hot="right")


@query(
    """
    SELECT o_orderkey, o_custkey, n_orders, total
    FROM orders LEFT JOIN (
        SELECT o_custkey AS customer, count(*) AS n_orders,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total
        FROM orders GROUP BY o_custkey
    ) ON customer = o_custkey
    """
)
def lookup_derived(t):
    totals = summarize(
        t.orders,
        "o_custkey",
        [
            ("n_orders", "count(*)"),
            ("total", "cast(sum(cast(o_totalprice AS decimal(18,2))) AS decimal(18,2))"),
        ],
    )
    orders = source_view(t.orders, ["o_orderkey", "o_custkey"])
    on = ("o_custkey", "o_custkey")
    return lookup(orders, totals, on, ["n_orders", "total"], hot="left")


# Aggregation


def _labelled_documents(t):
    documents = source_view(t.documents, ["doc_id", "lang"])
    return lookup(documents, t.labels, ("doc_id", "doc_id"), ["quality"])


@query("SELECT lang, count(*) AS n_rows FROM documents GROUP BY lang")
def agg_count_star(t):
    return summarize(t.documents, "lang", [("n_rows", F.count("*"))])


@query(
    """
    SELECT lang, count(quality) AS n_rated, count(*) AS n_rows
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY lang
    """
)
def agg_count_col(t):
    counts = [("n_rated", "count(quality)"), ("n_rows", "COUNT(*)")]
    return summarize(_labelled_documents(t), ["lang"], counts)


_FLAGS = ["l_returnflag", "l_linestatus"]


@query(
    """
    SELECT l_returnflag, l_linestatus,
           CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DECIMAL(38,2)) AS quantity,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(38,2)) AS price
    FROM lineitem GROUP BY l_returnflag, l_linestatus
    """
)
def agg_sum(t):
    sums = [
        ("quantity", "cast(sum(cast(l_quantity AS decimal(12,2))) AS decimal(38,2))"),
        ("price", "cast(sum(cast(l_extendedprice AS decimal(12,2))) AS decimal(38,2))"),
    ]
    return summarize(t.lineitem, _FLAGS, sums)


@query(
    """
    SELECT l_returnflag, l_linestatus, min(l_quantity) AS least, max(l_extendedprice) AS dearest,
           min(l_shipdate) AS first_shipped, max(l_shipdate) AS last_shipped
    FROM lineitem GROUP BY l_returnflag, l_linestatus
    """
)
def agg_min_max(t):
    bounds = [
        ("least", F.min("l_quantity")),
        ("dearest", F.max("l_extendedprice")),
        ("first_shipped", F.min("l_shipdate")),
        ("last_shipped", F.max("l_shipdate")),
    ]
    return summarize(t.lineitem, _FLAGS, bounds)


@query(
    """
    SELECT l_returnflag, l_linestatus, round(avg(l_quantity), 6) AS avg_quantity,
           round(avg(l_discount), 6) AS avg_discount
    FROM lineitem GROUP BY l_returnflag, l_linestatus
    """
)
def agg_avg(t):
    averages = [
        ("avg_quantity", "round(avg(l_quantity), 6)"),
        ("avg_discount", "round(avg(l_discount), 6)"),
    ]
    return summarize(t.lineitem, _FLAGS, averages)


@query(
    """
    SELECT l_returnflag, count(DISTINCT l_suppkey) AS suppliers,
           round(stddev_pop(l_quantity), 6) AS spread,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)))
                AS DECIMAL(38,4)) AS discounts
    FROM lineitem GROUP BY l_returnflag
    """
)
def agg_sql(t):
    aggregates = [
        ("suppliers", "count(DISTINCT l_suppkey)"),
        ("spread", "round(stddev_pop(l_quantity), 6)"),
        (
            "discounts",
            """cast(sum(cast(l_extendedprice AS decimal(12,2)) * cast(l_discount AS decimal(4,2)))
                    AS decimal(38,4))""",
        ),
    ]
    return summarize(t.lineitem, "l_returnflag", aggregates)


@query(
    """
    SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS n_lines
    FROM lineitem GROUP BY l_returnflag, l_linestatus, l_linenumber
    """
)
def agg_multi_key(t):
    keys = "l_returnflag, l_linestatus, , l_linenumber"
    return summarize(t.lineitem, keys, [("n_lines", F.count("*"))])


@query(
    """
    SELECT l_returnflag, l_linestatus,
           round(quantile_cont(l_extendedprice, 0.5), 6) AS median_price,
           round(quantile_cont(l_extendedprice, 0.1), 6) AS low_price,
           round(quantile_cont(l_extendedprice, 0.999), 6) AS high_price
    FROM lineitem GROUP BY l_returnflag, l_linestatus
    """
)
def agg_quantiles(t):
    wanted = [("median_price", 0.5), ("low_price", 0.1), ("high_price", 0.999)]
    found = quantiles(t.lineitem, _FLAGS, "l_extendedprice", wanted)
    return found.selectExpr(*_FLAGS, *[f"round({name}, 6) AS {name}" for name, _ in wanted])


@query(
    """
    SELECT l_suppkey, quantile_cont(CAST(l_quantity AS INTEGER), 0.5) AS median_quantity,
           quantile_cont(CAST(l_quantity AS INTEGER), 0.25) AS quarter
    FROM lineitem GROUP BY l_suppkey
    """
)
def agg_quantiles_of_suppliers(t):
    """Many groups with few values, each of which occurs often."""
    lines = t.lineitem.selectExpr("l_suppkey", "CAST(l_quantity AS int) AS quantity")
    return quantiles(lines, "l_suppkey", "quantity", [("median_quantity", 0.5), ("quarter", 0.25)])


# Reconciliation. The actual table is the expected one with faults: urgent open orders
# are lost, low-priority closed ones have another status and the dearest another amount,
# urgent pending ones occur again under other keys and dear closed ones under the same.


def _expected_orders(t):
    return t.orders.selectExpr(
        "o_orderkey AS k",
        "o_orderstatus AS st",
        "cast(o_totalprice AS decimal(18,2)) AS amt",
        "o_orderpriority AS prio",
    )


def _actual_orders(t):
    expected = _expected_orders(t)
    kept = keep(expected, "NOT (st = 'O' AND prio = '1-URGENT')").selectExpr(
        "k",
        "CASE WHEN st = 'F' AND prio = '5-LOW' THEN 'X' ELSE st END AS st",
        "cast(CASE WHEN st = 'F' AND amt > 450000 THEN amt + 1 ELSE amt END"
        " AS decimal(18,2)) AS amt",
        # Padding alone is no difference.
        "concat(' ', prio) AS prio",
    )
    shifted = keep(expected, "st = 'P' AND prio = '1-URGENT'").selectExpr(
        "-1 - k AS k", "st", "amt", "prio"
    )
    again = keep(expected, "st = 'F' AND amt > 400000")
    return kept.unionAll(shifted).unionAll(again)


_PAIR = """
    WITH e AS (
        SELECT o_orderkey AS k, o_orderstatus AS st,
               CAST(o_totalprice AS DECIMAL(18,2)) AS amt, o_orderpriority AS prio
        FROM orders
    ), a AS (
        SELECT k, CASE WHEN st = 'F' AND prio = '5-LOW' THEN 'X' ELSE st END AS st,
               CAST(CASE WHEN st = 'F' AND amt > 450000 THEN amt + 1 ELSE amt END
                    AS DECIMAL(18,2)) AS amt,
               concat(' ', prio) AS prio
        FROM e WHERE NOT (st = 'O' AND prio = '1-URGENT')
        UNION ALL SELECT -1 - k, st, amt, prio FROM e WHERE st = 'P' AND prio = '1-URGENT'
        UNION ALL SELECT * FROM e WHERE st = 'F' AND amt > 400000
    ), pairs AS (
        SELECT e.k, e.st IS DISTINCT FROM a.st AS st_differs,
               e.amt IS DISTINCT FROM a.amt AS amt_differs,
               trim(e.prio) IS DISTINCT FROM trim(a.prio) AS prio_differs
        FROM e JOIN a ON e.k IS NOT DISTINCT FROM a.k
    )
"""


@query(
    _PAIR
    + """
    SELECT (SELECT count(*) FROM e) AS expected_row_count,
           (SELECT count(*) FROM a) AS actual_row_count,
           CASE WHEN (SELECT count(*) FROM e) = (SELECT count(*) FROM a) THEN 'PASS'
                ELSE 'FAIL' END AS row_count_validation
    """
)
def recon_row_counts(t):
    return reconcile.compare_counts(_expected_orders(t), _actual_orders(t))


@query(
    _PAIR
    + """
    SELECT DISTINCT k FROM e
    WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.k IS NOT DISTINCT FROM e.k)
    """
)
def recon_missing_keys(t):
    return reconcile.missing_keys(_expected_orders(t), _actual_orders(t), "k")


@query(
    _PAIR
    + """
    SELECT DISTINCT k FROM a
    WHERE NOT EXISTS (SELECT 1 FROM e WHERE a.k IS NOT DISTINCT FROM e.k)
    """
)
def recon_extra_keys(t):
    return reconcile.extra_keys(_expected_orders(t), _actual_orders(t), "k")


@query(_PAIR + "SELECT k, count(*) AS key_rows FROM a GROUP BY k HAVING count(*) > 1")
def recon_duplicate_keys(t):
    return reconcile.duplicate_keys(_actual_orders(t), "k")


@query(
    _PAIR
    + """
    SELECT k, (SELECT count(*) FROM e WHERE e.k = pairs.k) AS expected_rows,
           (SELECT count(*) FROM a WHERE a.k = pairs.k) AS actual_rows,
           CAST(count(*) AS DECIMAL(38,0)) AS mismatched_pairs
    FROM pairs WHERE st_differs OR amt_differs OR prio_differs GROUP BY k
    """
)
def recon_mismatches(t):
    return reconcile.mismatches(_expected_orders(t), _actual_orders(t), "k")


@query(
    _PAIR
    + """
    , bad AS (SELECT DISTINCT k FROM pairs WHERE st_differs OR amt_differs OR prio_differs),
    both_sides AS (
        SELECT *, 1 AS e, 0 AS a FROM e UNION ALL SELECT *, 0 AS e, 1 AS a FROM a
    )
    SELECT k, st, amt, trim(prio) AS prio,
           CAST(sum(e) AS BIGINT) AS expected_rows, CAST(sum(a) AS BIGINT) AS actual_rows
    FROM both_sides WHERE k IN (SELECT k FROM bad)
    GROUP BY k, st, amt, trim(prio)
    """
)
def recon_mismatch_rows(t):
    return reconcile.mismatch_rows(_expected_orders(t), _actual_orders(t), "k")


@query(
    _PAIR
    + """
    SELECT 'st' AS column_name, CAST(count_if(st_differs) AS DECIMAL(38,0)) AS mismatched_pairs
    FROM pairs
    UNION ALL SELECT 'amt', CAST(count_if(amt_differs) AS DECIMAL(38,0)) FROM pairs
    UNION ALL SELECT 'prio', CAST(count_if(prio_differs) AS DECIMAL(38,0)) FROM pairs
    """
)
def recon_mismatches_by_column(t):
    return reconcile.mismatches_by_column(_expected_orders(t), _actual_orders(t), ["k"])


@query(
    _PAIR
    + """
    SELECT 'PASS' AS schema_validation,
           CASE WHEN n_e = n_a THEN 'PASS' ELSE 'FAIL' END AS row_count_validation,
           CASE WHEN missing + extra + mismatched = 0 THEN 'PASS' ELSE 'FAIL' END
               AS data_validation,
           CASE WHEN n_e = n_a AND missing + extra + mismatched = 0 THEN 'PASS' ELSE 'FAIL' END
               AS overall_status,
           n_e AS expected_row_count, n_a AS actual_row_count,
           missing AS missing_rows, extra AS extra_rows,
           CAST(mismatched AS DECIMAL(38,0)) AS mismatched_rows,
           twice_e AS duplicate_expected_keys, twice_a AS duplicate_actual_keys,
           CASE WHEN n_e = n_a THEN ''
                ELSE concat('row counts differ: expected ', n_e, ', actual ', n_a) END AS errors,
           CASE WHEN twice_e + twice_a = 0 THEN '' ELSE 'some keys occur more than once' END
               AS warnings,
           'k, st, amt, prio' AS expected_columns, 'k, st, amt, prio' AS actual_columns
    FROM (SELECT
        (SELECT count(*) FROM e) AS n_e,
        (SELECT count(*) FROM a) AS n_a,
        (SELECT count(*) FROM (SELECT DISTINCT k FROM e WHERE k NOT IN (SELECT k FROM a)))
            AS missing,
        (SELECT count(*) FROM (SELECT DISTINCT k FROM a WHERE k NOT IN (SELECT k FROM e)))
            AS extra,
        (SELECT count(*) FROM pairs WHERE st_differs OR amt_differs OR prio_differs)
            AS mismatched,
        (SELECT count(*) FROM (SELECT k FROM e GROUP BY k HAVING count(*) > 1)) AS twice_e,
        (SELECT count(*) FROM (SELECT k FROM a GROUP BY k HAVING count(*) > 1)) AS twice_a)
    """
)
def reconcile_report(t):
    return _flat(reconcile.report(_expected_orders(t), _actual_orders(t), "k"))


@query(
    """
    SELECT o_orderkey AS k, CAST(1 AS BIGINT) AS expected_rows, CAST(1 AS BIGINT) AS actual_rows,
           CAST(1 AS DECIMAL(38,0)) AS mismatched_pairs
    FROM orders
    WHERE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) IS DISTINCT FROM
          CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice + 1 ELSE o_totalprice END
    """
)
def recon_typed(t):
    # The same amounts as DECIMAL and as DOUBLE, but for low priorities.
    expected = t.orders.selectExpr("o_orderkey AS k", "cast(o_totalprice AS decimal(18,2)) AS amt")
    actual = t.orders.selectExpr(
        "o_orderkey AS k",
        "CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice + 1 ELSE o_totalprice END AS amt",
    )
    return reconcile.mismatches(expected, actual, "k", compare="typed")


@query(
    """
    SELECT o_orderkey AS k, CAST(1 AS BIGINT) AS expected_rows, CAST(1 AS BIGINT) AS actual_rows,
           CAST(1 AS DECIMAL(38,0)) AS mismatched_pairs
    FROM (SELECT o_orderkey, o_orderkey + 9007199254740992 AS v FROM orders)
    WHERE CAST(CAST(v AS DOUBLE) AS HUGEINT) <> CAST(v AS HUGEINT)
    """
)
def recon_typed_exact(t):
    # Whole numbers beyond 2^53, of which a DOUBLE holds the even ones.
    expected = t.orders.selectExpr("o_orderkey AS k", "o_orderkey + 9007199254740992 AS v")
    actual = expected.selectExpr("k", "CAST(v AS double) AS v")
    return reconcile.mismatches(expected, actual, "k", compare="typed")


@query(
    _PAIR
    + """
    SELECT 'FAIL' AS schema_validation,
           CASE WHEN n_e = n_a THEN 'PASS' ELSE 'FAIL' END AS row_count_validation,
           'SKIPPED' AS data_validation, 'FAIL' AS overall_status,
           n_e AS expected_row_count, n_a AS actual_row_count,
           CAST(NULL AS BIGINT) AS missing_rows, CAST(NULL AS BIGINT) AS extra_rows,
           CAST(NULL AS DECIMAL(38,0)) AS mismatched_rows,
           CAST(NULL AS BIGINT) AS duplicate_expected_keys,
           CAST(NULL AS BIGINT) AS duplicate_actual_keys,
           concat('columns differ: expected [''k'', ''st'', ''amt'', ''prio''], ',
                  'actual [''k'', ''st'', ''prio'', ''amt'']',
                  CASE WHEN n_e = n_a THEN ''
                       ELSE concat('; row counts differ: expected ', n_e, ', actual ', n_a) END)
               AS errors,
           '' AS warnings,
           'k, st, amt, prio' AS expected_columns, 'k, st, prio, amt' AS actual_columns
    FROM (SELECT (SELECT count(*) FROM e) AS n_e, (SELECT count(*) FROM a) AS n_a)
    """
)
def reconcile_report_schemas(t):
    actual = source_view(_actual_orders(t), ["k", "st", "prio", "amt"])
    return _flat(reconcile.report(_expected_orders(t), actual, "k"))


def _flat(report):
    return derive(
        report,
        [
            ("errors", "array_join(errors, '; ')"),
            ("warnings", "array_join(warnings, '; ')"),
            ("expected_columns", "array_join(expected_columns, ', ')"),
            ("actual_columns", "array_join(actual_columns, ', ')"),
        ],
    )


# Table checks


@query(
    """
    SELECT 'o_comment' AS column_name, 'missing' AS difference, count(*) AS table_rows FROM orders
    UNION ALL SELECT 'o_orderpriority', 'extra', count(*) FROM orders
    """
)
def column_diff(t):
    declared = [
        ("o_orderkey", "BIGINT"),
        ("o_custkey", "BIGINT"),
        ("o_orderstatus", "VARCHAR"),
        ("o_totalprice", "DOUBLE"),
        ("o_orderdate", "TIMESTAMP_NTZ"),
        ("o_comment", "VARCHAR"),
    ]
    return checks.column_diff(t.orders, declared)


@query(
    """
    SELECT l_orderkey, l_linenumber, count(*) AS occurrences
    FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
    """
)
def check_unique(t):
    return checks.unique(t.lineitem, ["l_orderkey", "l_linenumber"])


def _orphan_events(t):
    parents = keep(t.customer, "c_mktsegment = 'BUILDING'")
    return checks.references(t.events, parents, ("user_id", "c_custkey"))


@query(
    """
    SELECT * FROM events
    WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
    """
)
def check_references(t):
    return _orphan_events(t)


def _required_labels(t):
    labelled = derive(
        _labelled_documents(t), [("note", "CASE WHEN quality = 0 THEN ' ' ELSE lang END")]
    )
    return checks.required(labelled, ["doc_id", "lang", "quality", "note"])


@query(
    """
    WITH r AS (
        SELECT d.doc_id, lang, quality, CASE WHEN quality = 0 THEN ' ' ELSE lang END AS note
        FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
    ), s AS (
        SELECT 'doc_id' AS column_name, CAST(doc_id AS VARCHAR) AS v FROM r
        UNION ALL SELECT 'lang', lang FROM r
        UNION ALL SELECT 'quality', CAST(quality AS VARCHAR) FROM r
        UNION ALL SELECT 'note', note FROM r
    )
    SELECT column_name, count_if(v IS NULL)::BIGINT AS null_rows,
           count_if(coalesce(trim(v) = '', false))::BIGINT AS blank_rows, count(*) AS checked_rows
    FROM s GROUP BY column_name
    """
)
def check_required(t):
    return _required_labels(t)


@query(
    """
    WITH a AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F'),
         b AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'O')
    SELECT o_custkey, 'missing' AS difference FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
    UNION ALL
    SELECT o_custkey, 'extra' AS difference FROM (SELECT * FROM b EXCEPT SELECT * FROM a)
    """
)
def check_set_diff(t):
    closed = keep(t.orders, "o_orderstatus = 'F'")
    still_open = keep(t.orders, "o_orderstatus = 'O'")
    return checks.set_diff(closed, still_open, "o_custkey")


_SUMMARY = """
    SELECT 'line_key_unique' AS rule, 'warning' AS severity, count(*) AS violations,
           CASE WHEN count(*) > 0 THEN 'WARNING' ELSE 'VALID' END AS status
    FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
    UNION ALL
    SELECT 'event_user_known', 'error', count(*),
           CASE WHEN count(*) > 0 THEN 'INVALID' ELSE 'VALID' END
    FROM events
    WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
    UNION ALL
    SELECT 'label_complete', 'error', count(*),
           CASE WHEN count(*) > 0 THEN 'INVALID' ELSE 'VALID' END
    FROM (SELECT 1 FROM labels HAVING count(*) > count(quality)
          UNION ALL SELECT 1 FROM labels HAVING count(*) > count(toxic))
"""


def _summary(t):
    gaps = keep(checks.required(t.labels, ["quality", "toxic"]), "null_rows + blank_rows > 0")
    return checks.summary(
        [
            ("line_key_unique", "warning", check_unique(t)),
            ("event_user_known", "error", _orphan_events(t)),
            ("label_complete", "error", gaps),
        ]
    )


@query(_SUMMARY)
def check_summary(t):
    return _summary(t)


@query(
    f"""
    SELECT CASE WHEN count_if(status = 'INVALID') > 0 THEN 'INVALID' ELSE 'VALID' END AS status,
           count_if(status = 'INVALID')::BIGINT AS errors,
           count_if(status = 'WARNING')::BIGINT AS warnings
    FROM ({_SUMMARY})
    """
)
def check_verdict(t):
    return checks.verdict(_summary(t))


_LINE_RULES = """
    SELECT 'line_key_unique' AS rule, 'warning' AS severity, count(*) AS violations,
           CASE WHEN count(*) > 0 THEN 'WARNING' ELSE 'VALID' END AS status
    FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
    UNION ALL
    SELECT 'line_part_unique', 'warning', count(*),
           CASE WHEN count(*) > 0 THEN 'WARNING' ELSE 'VALID' END
    FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_partkey, l_suppkey HAVING count(*) > 1)
    UNION ALL
    SELECT 'supplier_known', 'error', count(*),
           CASE WHEN count(*) > 0 THEN 'INVALID' ELSE 'VALID' END
    FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)
    UNION ALL
    SELECT 'order_known', 'error', count(*),
           CASE WHEN count(*) > 0 THEN 'INVALID' ELSE 'VALID' END
    FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
    UNION ALL
    SELECT 'dear_and_free_of_tax', 'warning', count(*),
           CASE WHEN count(*) > 0 THEN 'WARNING' ELSE 'VALID' END
    FROM lineitem WHERE l_tax = 0 AND l_extendedprice > 50000
    UNION ALL
    SELECT 'flags_given', 'error', count(*),
           CASE WHEN count(*) > 0 THEN 'INVALID' ELSE 'VALID' END
    FROM lineitem WHERE l_returnflag IS NULL OR trim(l_returnflag) = ''
        OR l_linestatus IS NULL OR trim(l_linestatus) = ''
"""


@query(_LINE_RULES)
def check_table_summary(t):
    """Six rules on one table, which is read once."""
    return checks.table_summary(
        t.lineitem,
        [
            checks.unique_rule("line_key_unique", "warning", "l_orderkey, l_linenumber"),
            checks.unique_rule("line_part_unique", "warning", ["l_orderkey", "l_partkey", "l_suppkey"]),
            checks.reference_rule(
                "supplier_known", "error", keep(t.supplier, "s_acctbal > 0"), ("l_suppkey", "s_suppkey")
            ),
            checks.reference_rule("order_known", "error", t.orders, ("l_orderkey", "o_orderkey")),
            checks.row_rule(
                "dear_and_free_of_tax", "warning", "l_tax = 0 AND l_extendedprice > 50000"
            ),
            checks.required_rule("flags_given", "error", "l_returnflag, l_linestatus"),
        ],
    )


# Whole jobs


_CUSTOMER_ORDERS = """
    SELECT c_custkey AS customer_id, upper(trim(c_name)) AS customer_name,
           n_name AS country_name, r_name AS region,
           CAST(count(o_orderkey) AS INTEGER) AS total_orders,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total_amount,
           CAST(max(o_orderdate) AS DATE) AS last_order_date
    FROM customer
    JOIN orders ON o_custkey = c_custkey
    LEFT JOIN nation ON n_nationkey = c_nationkey
    LEFT JOIN region ON r_regionkey = n_regionkey
    WHERE o_orderstatus = 'F' AND o_totalprice > 0
    GROUP BY c_custkey, upper(trim(c_name)), n_name, r_name
"""


_TARGET_COLUMNS = "'" + ", ".join(c.name for c in customer_orders.TARGET) + "'"


@query(_CUSTOMER_ORDERS)
def customer_order_summary(t):
    return customer_orders.customer_order_summary(t.customer, t.orders, t.nation, t.region)


def _target(t) -> tuple[str, str | None]:
    """Name and place of a target: one per input and application, in the shared folder
    where the cluster names one."""
    run = f"{t.directory}\n{t.spark.conf.get('spark.app.id')}"
    name = "customer_order_summary_" + hashlib.sha256(run.encode()).hexdigest()
    shared = t.spark.conf.get("spark.checkpoint.dir", None)
    return name, f"{shared.rstrip('/')}/{name}" if shared else None


@query(
    f"""
    SELECT 'INVALID' AS status, 'segment' AS missing_columns,
           'region, last_order_date' AS extra_columns,
           'total_amount: decimal(18,2), not decimal(20,2)' AS other_types, count(*) AS row_count
    FROM ({_CUSTOMER_ORDERS})
    """
)
def verify_target(t):
    name, location = _target(t)
    name, location = f"checked_{name}", location and f"{location}_checked"
    loaded = ["last_order_date", "region", "total_amount", "customer_id"]
    declared = [c for c in customer_orders.TARGET if c.name in loaded]
    target = ensure_table(t.spark, name, declared, schema=None, location=location)
    summary = customer_order_summary(t)
    load_overwrite(source_view(summary, loaded), target)
    wanted = [("customer_id", "BIGINT"), ("segment", "VARCHAR"), ("total_amount", "DECIMAL", 20)]
    return checks.verify_target(t.spark, target, wanted).drop("table_name")


@query(
    f"""
    SELECT 'VALID' AS status, '' AS missing_columns, '' AS extra_columns, '' AS other_types,
           count(*) AS loaded_rows, CAST(0 AS BIGINT) AS failed_casts,
           'PASS' AS schema_validation, 'PASS' AS row_count_validation,
           'PASS' AS data_validation, 'PASS' AS overall_status,
           count(*) AS expected_row_count, count(*) AS actual_row_count,
           CAST(0 AS BIGINT) AS missing_rows, CAST(0 AS BIGINT) AS extra_rows,
           CAST(0 AS DECIMAL(38,0)) AS mismatched_rows,
           CAST(0 AS BIGINT) AS duplicate_expected_keys,
           CAST(0 AS BIGINT) AS duplicate_actual_keys, '' AS errors, '' AS warnings,
           {_TARGET_COLUMNS} AS expected_columns, {_TARGET_COLUMNS} AS actual_columns
    FROM ({_CUSTOMER_ORDERS})
    """
)
def load_and_verify_(t):
    tables = (t.customer, t.orders, t.nation, t.region)
    name, location = _target(t)
    return _flat(
        load_and_verify(
            customer_orders.customer_order_summary(*tables),
            customer_orders.expected_summary(*tables),
            name,
            customer_orders.TARGET,
            customer_orders.KEYS,
            schema=None,
            location=location,
        )
    )


@query(
    """
    SELECT CAST(o_orderkey AS BIGINT) AS order_id, CAST(o_orderpriority AS VARCHAR) AS priority,
           o_orderstatus AS order_status
    FROM orders WHERE o_orderpriority <> '1-URGENT' AND o_orderstatus <> 'P'
    """
)
def load_partitions(t):
    """A partitioned target after two loads: the second brings other partitions than the first."""
    declared = [("order_id", "BIGINT"), ("priority", "VARCHAR"), ("order_status", "VARCHAR")]
    name, location = _target(t)
    target = ensure_table(
        t.spark, f"{name}_parts", declared, None, location=location and f"{location}_parts",
        partitioned_by=["order_status"],
    )
    orders = map_columns(
        t.orders,
        [("o_orderkey", "order_id"), ("o_orderpriority", "priority"), ("o_orderstatus", "order_status")],
    )
    load_overwrite(keep(orders, "order_status <> 'O'"), target)
    load_overwrite(keep(orders, "priority <> '1-URGENT' AND order_status <> 'P'"), target)
    return t.spark.table(target)


@query(
    """
    SELECT count(*) AS loaded_rows,
           CAST(count_if(o_orderkey % 10 = 0) AS BIGINT) AS failed_casts,
           'FAIL' AS overall_status, CAST(count_if(o_orderkey % 10 = 0) AS BIGINT) AS mismatched_rows
    FROM orders
    """
)
def load_counts(t):
    """What a load counts while it writes: every tenth total is no number and becomes NULL."""
    name, location = _target(t)
    declared = [("o_orderkey", "BIGINT"), ("total", "DECIMAL", 18, 2)]
    total = "CASE WHEN o_orderkey % 10 = 0 THEN 'unknown' ELSE string(o_totalprice) END AS total"
    found = load_and_verify(
        t.orders.selectExpr("o_orderkey", total),
        conform(t.orders.selectExpr("o_orderkey", "o_totalprice AS total"), declared),
        f"{name}_counts",
        declared,
        "o_orderkey",
        schema=None,
        location=location and f"{location}_counts",
        on_error="null",
    )
    return found.selectExpr(
        "loaded_rows", "failed_casts", "overall_status", "bigint(mismatched_rows) AS mismatched_rows"
    )
