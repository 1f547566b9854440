"""Grouped aggregation."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.text import quoted
from tablewright.operators.columns import distinct_names

SLICE = 1_000_000  # rows of a slice of the values, about
SLICES = 16_384  # most slices


def summarize(
    df: DataFrame, by: str | Sequence[str], aggregates: Iterable[tuple[str, str | Column]]
) -> DataFrame:
    """Group keys followed by the named aggregates.

    ``by`` is a list or comma-separated text; blanks are dropped. Aggregates are
    Columns or Spark SQL text, such as ``("total", "sum(a * b)")``.

    count, sum, min, max, avg, the deviations and DISTINCT counts are merged on
    the map side, so a group that holds a large share of the rows sends only one
    partial row per task through the shuffle. ``median``, ``percentile`` and
    ``collect_list`` hold a whole group in one task; ``percentile_approx`` does
    not, and neither does ``quantiles`` below.
    """
    keys = group_keys(by)
    columns = [(F.expr(e) if isinstance(e, str) else e).alias(name) for name, e in aggregates]
    if not keys:
        raise ValueError("aggregation has no group keys")
    if not columns:
        raise ValueError("aggregation has no aggregate expressions")
    result = df.groupBy(*map(quoted, keys)).agg(*columns)
    distinct_names(result.columns)
    return result


def quantiles(
    df: DataFrame, by: str | Sequence[str], column: str, wanted: Iterable[tuple[str, float]]
) -> DataFrame:
    """Exact interpolated quantiles of groups of any size: the group keys, then a double for each
    ``(name, share)``, equal to ``percentile(column, share)``; a share of 0.5 is the median.

    NULLs do not count; a group of nothing else has NULLs. NaN is larger than any number; zero has no
    sign. Values
    are cut into slices that hold about ``SLICE`` rows of the whole table, so no more of any group.
    Counts of groups by slice, added up along the slices, tell in which one a wanted rank lies; only
    those slices' values are then put in order, each (group, slice) for itself. Equal values are
    merged on the map side and travel as one, however often they occur.

    The row count and, for more than one slice, approximate bounds (``SLICES`` at most) are computed
    at once; all else is lazy. Bounds steer the plan only, never the result.
    """
    keys = group_keys(by)
    wanted = list(wanted)
    if not keys:
        raise ValueError("aggregation has no group keys")
    if not wanted:
        raise ValueError("aggregation has no quantiles")
    if any(not 0 <= share <= 1 for _, share in wanted):
        raise ValueError(f"shares must be from 0 to 1, not {[share for _, share in wanted]}")
    if not isinstance(df.select(quoted(column)).schema[0].dataType, T.NumericType):
        raise ValueError(f"quantiles are of numbers, {column!r} is none")
    ks = [f"k{i}" for i in range(len(keys))]
    rows = df.select(*[F.col(quoted(k)).alias(n) for k, n in zip(keys, ks)], F.col(quoted(column)).alias("v"))
    slice_ = _slice("CAST(v AS double)", _bounds(rows))
    counted = rows.groupBy(*ks, "v").agg(F.count("*").alias("c")).selectExpr("*", f"{slice_} AS slice")

    along = Window.partitionBy(*ks).orderBy("slice")
    whole = Window.partitionBy(*ks)
    held = "sum(CASE WHEN slice >= 0 THEN c ELSE 0L END)"
    tallied = (
        counted.groupBy(*ks, "slice").agg(F.expr("sum(c) AS c"))
        .withColumn("n", F.expr(held).over(whole))
        .withColumn("upto", F.expr(held).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    )
    ranks = {}
    for i, (_, share) in enumerate(wanted):
        at = f"((n - 1) * {float(share)!r}D)"
        ranks[f"v{i}"], ranks[f"w{i}"] = f"CAST(floor({at}) AS bigint) + 1", f"CAST(ceil({at}) AS bigint) + 1"
    needed = " OR ".join(f"{rank} BETWEEN upto - c + 1 AND upto" for rank in ranks.values())
    chosen = tallied.filter(f"slice >= 0 AND ({needed})").selectExpr(*ks, "slice", "n", "upto - c AS before")
    same = " AND ".join(f"chosen.{c} <=> counted.{c}" for c in [*ks, "slice"])
    inside = (
        counted.alias("counted").join(chosen.alias("chosen"), F.expr(same))
        .selectExpr(*[f"counted.{k}" for k in ks], "counted.slice", "v", "c", "n", "before")
    )
    order = Window.partitionBy(*ks, "slice").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    placed = inside.withColumn("upto", F.col("before") + F.sum("c").over(order))
    picked = placed.groupBy(*ks).agg(
        F.max("n").alias("n"),
        *[
            F.expr(f"CAST(max(CASE WHEN {rank} BETWEEN upto - c + 1 AND upto THEN v END) AS double) AS {name}")
            for name, rank in ranks.items()
        ],
    )
    named = [f"{k} AS {quoted(name)}" for k, name in zip(ks, keys)]
    values = []
    for i, (name, share) in enumerate(wanted):
        at = f"((n - 1) * {float(share)!r}D)"
        between = f"(ceil({at}) - {at}) * v{i} + ({at} - floor({at})) * w{i}"
        values.append(f"CASE WHEN v{i} = w{i} THEN v{i} ELSE {between} END AS {quoted(name)}")
    # A group without numbers has one slice, that of its NULLs.
    nothing = tallied.filter("n = 0").selectExpr(
        *named, *[f"CAST(NULL AS double) AS {quoted(name)}" for name, _ in wanted]
    )
    result = picked.selectExpr(*named, *values).unionAll(nothing)
    distinct_names(result.columns)
    return result


def _bounds(rows: DataFrame) -> list[float]:
    """Where slices of about ``SLICE`` rows begin, but for the first."""
    finite = rows.selectExpr("CAST(v AS double) AS v").filter("abs(v) < double('infinity')")
    n = finite.count()
    slices = min(SLICES, -(-n // SLICE))
    if slices < 2:
        return []
    shares = [i / slices for i in range(1, slices)]
    found = finite.agg(F.percentile_approx("v", shares, max(10_000, 4 * slices))).first()[0]
    return sorted(set(found))


def _slice(value: str, bounds: Sequence[float]) -> str:
    """How many bounds do not exceed the value, found by halving; -1 for NULL."""
    if not bounds:
        return f"CASE WHEN {value} IS NULL THEN -1 ELSE 0 END"
    step, steps = 1, []
    while step <= len(bounds):
        steps.insert(0, step)
        step *= 2
    listed = ", ".join(f"double('{b!r}')" for b in bounds)
    ahead = f"i + s <= {len(bounds)} AND element_at(array({listed}), i + s) <= {value}"
    found = f"aggregate(array({', '.join(map(str, steps))}), 0, (i, s) -> CASE WHEN {ahead} THEN i + s ELSE i END)"
    return f"CASE WHEN {value} IS NULL THEN -1 ELSE {found} END"


def group_keys(by: str | Sequence[str] | None) -> list[str]:
    parts = by.split(",") if isinstance(by, str) else by or []
    return [part.strip() for part in parts if part and part.strip()]
