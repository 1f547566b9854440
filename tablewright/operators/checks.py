"""Data-quality checks on tables; each returns its findings as rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.text import as_column, comparable_text, quoted
from tablewright.functions.types import declared_columns
from tablewright.operators.aggregates import group_keys
from tablewright.operators.columns import rows_of
from tablewright.operators.joins import join

SEVERITIES = ("error", "warning")


def column_differences(df: DataFrame, declared: Iterable) -> tuple[list[str], list[str]]:
    """Names of declared columns the table lacks, and of columns it has beyond them."""
    wanted = [c.name for c in declared_columns(declared)]
    return [c for c in wanted if c not in df.columns], [c for c in df.columns if c not in wanted]


def column_diff(df: DataFrame, declared: Iterable) -> DataFrame:
    """Declared columns the table lacks and columns it has beyond them.

    Rows: ``column_name``, ``difference`` (``missing`` or ``extra``) and
    ``table_rows``, the row count of the table. Order does not matter.
    """
    missing, extra = column_differences(df, declared)
    found = [(c, "missing") for c in missing] + [(c, "extra") for c in extra]
    counted = df.agg(F.count("*").alias("n"))
    if not found:
        return counted.filter("false").selectExpr(
            "'' AS column_name", "'' AS difference", "n AS table_rows"
        )
    return rows_of(
        counted,
        ["column_name", "difference", "table_rows"],
        [(F.lit(c), F.lit(d), F.col("n")) for c, d in found],
    )


def verify_target(spark: SparkSession, full_name: str, declared: Iterable) -> DataFrame:
    """Read a loaded table back: one row with its columns' verdict and its row count.

    ``status`` is VALID if the declared columns are exactly those of the table, in
    any order, and have the declared types; ``other_types`` tells which have not.
    ``full_name`` is a qualified name as returned by ``ensure_table``.
    """
    df = spark.table(full_name)
    missing, extra = column_differences(df, declared)
    other = type_differences(df, declared)
    return df.agg(
        F.lit(full_name).alias("table_name"),
        F.lit("INVALID" if missing or extra or other else "VALID").alias("status"),
        F.lit(", ".join(missing)).alias("missing_columns"),
        F.lit(", ".join(extra)).alias("extra_columns"),
        F.lit(", ".join(other)).alias("other_types"),
        F.count("*").alias("row_count"),
    )


def type_differences(df: DataFrame, declared: Iterable) -> list[str]:
    """``name: type, not declared type`` of the declared columns that have another type."""
    have = {f.name: f.dataType for f in df.schema}
    wanted = [(c.name, T.DataType.fromDDL(c.spark_type)) for c in declared_columns(declared)]
    return [
        f"{name}: {have[name].simpleString()}, not {kind.simpleString()}"
        for name, kind in wanted
        if name in have and have[name] != kind
    ]


def unique(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Values that occur more than once, with their number of rows as ``occurrences``."""
    columns = _named(columns)
    grouped = df.groupBy(*map(quoted, columns)).agg(F.count("*").alias("occurrences"))
    return grouped.filter("occurrences > 1")


def references(
    child: DataFrame,
    parent: DataFrame,
    on: tuple[str, str] | Sequence[tuple[str, str]],
    nulls: str = "orphan",
    colocated: bool = False,
) -> DataFrame:
    """Child rows whose reference is not among the parents.

    A reference with a NULL in it finds no parent and is reported, or is passed
    over with ``nulls="ignore"``. ``colocated`` as in ``join``.
    """
    if nulls not in ("orphan", "ignore"):
        raise ValueError(f"nulls must be 'orphan' or 'ignore', not {nulls!r}")
    if nulls == "ignore":
        pairs = [on] if isinstance(on, tuple) and isinstance(on[0], str) else on
        child = child.dropna(subset=[c for c, _ in pairs])
    return join(child, parent, on, "LEFT ANTI", colocated=colocated)


def required(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Per required column the rows where it is NULL or, as text, blank (one pass).

    Rows: ``column_name``, ``null_rows``, ``blank_rows``, ``checked_rows``.
    """
    columns = _named(columns)
    counts = df.agg(
        F.count("*").alias("n"),
        *[F.count_if(as_column(c).isNull()).alias(f"null{i}") for i, c in enumerate(columns)],
        *[F.count_if(comparable_text(c) == "").alias(f"blank{i}") for i, c in enumerate(columns)],
    )
    return rows_of(
        counts,
        ["column_name", "null_rows", "blank_rows", "checked_rows"],
        [
            (F.lit(c), F.col(f"null{i}"), F.col(f"blank{i}"), F.col("n"))
            for i, c in enumerate(columns)
        ],
    )


def set_diff(a: DataFrame, b: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Distinct values in only one of two tables, NULL equal to NULL.

    Rows: the columns and ``difference``: ``missing`` if only ``a`` has the value,
    ``extra`` if only ``b`` has. One aggregation over both tables, no join.
    """
    columns = _named(columns)
    picked = [quoted(c) for c in columns]
    both = a.selectExpr(*picked, "1 AS __sides").unionAll(b.selectExpr(*picked, "2 AS __sides"))
    seen = both.groupBy(*picked).agg(F.bit_or("__sides").alias("__sides"))
    tag = "CASE WHEN __sides = 1 THEN 'missing' ELSE 'extra' END AS difference"
    return seen.filter("__sides < 3").selectExpr(*picked, tag)


def summary(rules: Iterable[tuple[str, str, DataFrame]]) -> DataFrame:
    """Per ``(rule, severity, violations)`` the number of violations and a status.

    Rows: ``rule``, ``severity``, ``violations``, ``status``. A rule with violations
    is INVALID if its severity is ``error`` and WARNING if it is ``warning``.
    """
    lines = []
    for rule, severity, violations in rules:
        if severity not in SEVERITIES:
            raise ValueError(f"severity of {rule!r} must be one of {SEVERITIES}, not {severity!r}")
        broken = "INVALID" if severity == "error" else "WARNING"
        lines.append(
            violations.agg(F.count("*").alias("violations")).select(
                F.lit(rule).alias("rule"),
                F.lit(severity).alias("severity"),
                "violations",
                F.when(F.col("violations") > 0, broken).otherwise("VALID").alias("status"),
            )
        )
    if not lines:
        raise ValueError("there are no rules to summarise")
    return reduce(DataFrame.unionAll, lines)


class Rule(NamedTuple):
    """A rule on one table, made by ``row_rule``, ``required_rule``, ``unique_rule`` or
    ``reference_rule``."""

    name: str
    severity: str
    broken: str | Column | None = None
    columns: tuple[str, ...] = ()
    parent: DataFrame | None = None
    parent_columns: tuple[str, ...] = ()
    nulls: str = "orphan"


def row_rule(name: str, severity: str, broken: str | Column) -> Rule:
    """Violations are rows for which ``broken`` is true."""
    return Rule(name, severity, broken)


def required_rule(name: str, severity: str, columns: str | Sequence[str]) -> Rule:
    """Violations are rows in which one of the columns is NULL or, as text, blank."""
    blank = [as_column(c).isNull() | (comparable_text(c) == "") for c in _named(columns)]
    return Rule(name, severity, reduce(Column.__or__, blank))


def unique_rule(name: str, severity: str, columns: str | Sequence[str]) -> Rule:
    """Violations are values that occur more than once, as ``unique`` returns them."""
    return Rule(name, severity, columns=tuple(_named(columns)))


def reference_rule(
    name: str,
    severity: str,
    parent: DataFrame,
    on: tuple[str, str] | Sequence[tuple[str, str]],
    nulls: str = "orphan",
) -> Rule:
    """Violations are rows whose reference is not among the parents, as ``references`` returns them."""
    if nulls not in ("orphan", "ignore"):
        raise ValueError(f"nulls must be 'orphan' or 'ignore', not {nulls!r}")
    pairs = [on] if isinstance(on, tuple) and isinstance(on[0], str) else list(on)
    child, other = zip(*pairs)
    return Rule(name, severity, None, child, parent, other, nulls)


def table_summary(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """The rows of ``summary`` for rules on one table, which is read once for all of them.

    Each row becomes an entry for every key rule, with the rule's columns alone, and one for
    every row rule it breaks; parents add theirs. One grouping by rule and key counts them
    all, merged on the map side, so neither many rules nor a frequent key make it costly.
    Columns of a reference have the same type on both sides, or are both whole numbers.
    """
    rules = list(rules)
    if not rules:
        raise ValueError("there are no rules to summarise")
    for rule in rules:
        if rule.severity not in SEVERITIES:
            raise ValueError(
                f"severity of {rule.name!r} must be one of {SEVERITIES}, not {rule.severity!r}"
            )
        for table, names in ((df, rule.columns), (rule.parent, rule.parent_columns)):
            absent = [c for c in names if c not in table.columns]
            if absent:
                raise ValueError(f"columns {absent} of {rule.name!r} are not among {table.columns}")
    key_columns = list(dict.fromkeys(c for rule in rules for c in rule.columns))
    kinds = {c: _key_type(c, df, rules) for c in key_columns}

    def entry(i: int, own: dict[str, str], n: str, parent: int) -> str:
        keys = [
            f"CAST({own.get(c, 'NULL')} AS {kinds[c]}) AS k{j}" for j, c in enumerate(key_columns)
        ]
        return f"struct({', '.join([f'{i} AS rule', *keys, f'{n} AS n', f'{parent} AS parent'])})"

    entries, parents, counts = [], [], []
    flags = {}
    for i, rule in enumerate(rules):
        own = {c: quoted(c) for c in rule.columns}
        if rule.broken is not None:
            flags[f"__broken{i}"] = F.expr(rule.broken) if isinstance(rule.broken, str) else rule.broken
            entries.append(f"CASE WHEN __broken{i} THEN {entry(i, {}, '1L', 0)} END")
            counts.append(f"sum(CASE WHEN rule = {i} THEN n END)")
        elif rule.parent is None:
            entries.append(entry(i, own, "1L", 0))
            counts.append(f"count_if(rule = {i} AND n > 1)")
        else:
            known = " AND ".join(f"{c} IS NOT NULL" for c in own.values())
            mine = entry(i, own, "1L", 0)
            entries.append(mine if rule.nulls == "orphan" else f"CASE WHEN {known} THEN {mine} END")
            # A NULL in a reference finds no parent, not even a NULL.
            theirs = dict(zip(rule.columns, map(quoted, rule.parent_columns)))
            there = rule.parent.dropna(subset=list(rule.parent_columns))
            parents.append(there.selectExpr(f"inline(array({entry(i, theirs, '0L', 1)}))"))
            counts.append(f"sum(CASE WHEN rule = {i} AND parent = 0 THEN n END)")
    listed = df.withColumns(flags) if flags else df
    listed = listed.selectExpr(f"inline(array_compact(array({', '.join(entries)})))")
    keys = [f"k{j}" for j in range(len(key_columns))]
    seen = (
        reduce(DataFrame.unionAll, parents, listed)
        .groupBy("rule", *keys)
        .agg(F.sum("n").alias("n"), F.max("parent").alias("parent"))
    )
    totals = seen.agg(*[F.expr(f"coalesce({c}, 0L)").alias(f"c{i}") for i, c in enumerate(counts)])
    return rows_of(
        totals,
        ["rule", "severity", "violations", "status"],
        [
            (
                F.lit(rule.name),
                F.lit(rule.severity),
                F.col(f"c{i}"),
                F.when(F.col(f"c{i}") > 0, "INVALID" if rule.severity == "error" else "WARNING").otherwise("VALID"),
            )
            for i, rule in enumerate(rules)
        ],
    )


def _key_type(column: str, df: DataFrame, rules: Sequence[Rule]) -> str:
    """A type that holds the values of a key column and of what it refers to."""
    kind = df.schema[column].dataType
    for rule in rules:
        for own, other in zip(rule.columns, rule.parent_columns):
            theirs = rule.parent.schema[other].dataType
            if own != column or theirs == df.schema[column].dataType:
                continue
            if not isinstance(kind, T.IntegralType) or not isinstance(theirs, T.IntegralType):
                raise ValueError(
                    f"{rule.name!r} compares {kind.simpleString()} with {theirs.simpleString()}; "
                    "cast one of them"
                )
            kind = T.LongType()
    return kind.simpleString()


def verdict(summary_rows: DataFrame) -> DataFrame:
    """One row over a ``summary``: INVALID if an error rule is broken, else VALID."""
    return summary_rows.agg(
        F.when(F.count_if(F.col("status") == "INVALID") > 0, "INVALID")
        .otherwise("VALID")
        .alias("status"),
        F.count_if(F.col("status") == "INVALID").alias("errors"),
        F.count_if(F.col("status") == "WARNING").alias("warnings"),
    )


def _named(columns: str | Sequence[str]) -> list[str]:
    columns = group_keys(columns)
    if not columns:
        raise ValueError("no columns are given to check")
    return columns
