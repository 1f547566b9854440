"""Load a result into its target table and check what arrived."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tablewright.functions.text import quoted
from tablewright.functions.types import declared_columns
from tablewright.operators.checks import column_differences, type_differences
from tablewright.operators.columns import conform
from tablewright.operators.reconcile import report
from tablewright.sources.tables import TARGET_SCHEMA, ensure_table, load_overwrite


def load_and_verify(
    result: DataFrame,
    expected: DataFrame,
    name: str,
    declared: Iterable,
    keys: str | Sequence[str],
    schema: str | None = TARGET_SCHEMA,
    catalog: str | None = None,
    fmt: str = "parquet",
    location: str | None = None,
    on_error: str = "raise",
    partitioned_by: Sequence[str] = (),
) -> DataFrame:
    """Create the target, overwrite it with ``result``, read it back and check it.

    Returns one row: ``status``, ``missing_columns``, ``extra_columns`` and ``other_types`` of
    the target against the declaration, ``loaded_rows`` and ``failed_casts`` of the load, then
    the columns of ``reconcile.report`` of the loaded table against ``expected``. The load runs
    at once, the checks when the row is asked for.

    Rows, and values that do not fit their declared type (with ``on_error="null"``, else the load
    fails on the first), are counted while the load writes; the source is not read again.
    """
    spark = result.sparkSession
    declared = list(declared)
    target = ensure_table(spark, name, declared, schema, catalog, fmt, location, partitioned_by)
    observed = Observation()
    counts = [F.count(F.lit(1)).alias("loaded_rows"), _failed_casts(result, declared, on_error)]
    load_overwrite(conform(result.observe(observed, *counts), declared, on_error), target)
    loaded = spark.table(target)
    missing, extra = column_differences(loaded, declared)
    other = type_differences(loaded, declared)
    return report(expected, loaded, keys).select(
        F.lit("INVALID" if missing or extra or other else "VALID").alias("status"),
        F.lit(", ".join(missing)).alias("missing_columns"),
        F.lit(", ".join(extra)).alias("extra_columns"),
        F.lit(", ".join(other)).alias("other_types"),
        *[F.lit(observed.get.get(c, 0)).cast("long").alias(c) for c in ("loaded_rows", "failed_casts")],
        "*",
    )


def _failed_casts(df: DataFrame, declared: Iterable, on_error: str):
    """The number of values that become NULL by the cast to their declared type."""
    failed = F.lit(0).cast("long")
    for c in declared_columns(declared) if on_error == "null" else ():
        value = F.col(quoted(c.name))
        failed = failed + F.count_if(value.isNotNull() & value.try_cast(c.spark_type).isNull())
    # An observed column has to be an aggregate.
    return (F.max(F.lit(0)).cast("long") if on_error != "null" else failed).alias("failed_casts")
