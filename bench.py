"""Time the headline queries and print one JSON line.

Reads ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``. Each query is warmed up twice
and then run five times; its time is the median. All rows are produced and dropped.
``seven_actions`` takes the counts of ``reconcile_report`` with the usual one action
per count; it and the queries of ``MORE`` are not part of the total, which so stays
comparable from round to round.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tablewright.functions import comparable_text  # noqa: E402
from tablewright.plans import queries as q  # noqa: E402

HEADLINE = [
    "customer_order_summary",
    "reconcile_report",
    "recon_mismatches_by_column",
    "recon_missing_keys",
    "load_and_verify",
    "join_inner",
    "join_full",
    "join_theta",
    "join_anti",
    "lookup_derived",
    "lookup_fanout",
    "derive_columns",
    "agg_sum",
    "agg_sql",
    "check_unique",
    "check_references",
    "check_set_diff",
]
MORE = ["join_range", "agg_quantiles", "check_table_summary", "load_partitions"]
WARM_UPS = 2
RUNS = 5


def seven_actions(t) -> None:
    """The counts of a reconciliation, each by its own action."""
    e, a = q._expected_orders(t), q._actual_orders(t)
    e.count()
    a.count()
    e_keys, a_keys = e.select("k").distinct().alias("e"), a.select("k").distinct().alias("a")
    same_key = F.col("e.k").eqNullSafe(F.col("a.k"))
    e_keys.join(a_keys, same_key, "left_anti").count()
    a_keys.join(e_keys, same_key, "left_anti").count()
    for df in (e, a):
        df.groupBy("k").count().filter("count > 1").count()
    differs = F.lit(False)
    for c in ("st", "amt", "prio"):
        one, two = comparable_text(F.col(f"e.{c}")), comparable_text(F.col(f"a.{c}"))
        differs = differs | ~one.eqNullSafe(two)
    e.alias("e").join(a.alias("a"), same_key, "full_outer").filter(same_key & differs).count()


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    for _ in range(WARM_UPS):
        action()
    seconds = []
    for _ in range(RUNS):
        start = time.perf_counter()
        action()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds), 4)


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {
        name: timed(lambda name=name: run(q.QUERIES[name](spark, directory))) for name in HEADLINE
    }
    compare = {"seven_actions": timed(lambda: seven_actions(q.Tables(spark, directory)))}
    compare |= {
        name: timed(lambda name=name: run(q.QUERIES[name](spark, directory))) for name in MORE
    }
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "compare": compare,
                "sf": os.path.basename(directory.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
