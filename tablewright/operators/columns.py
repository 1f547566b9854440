"""Column-wise operators: projection, renaming, derivation, casting."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.text import quoted
from tablewright.functions.types import Declared, declared_columns


def source_view(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The declared columns of a source, or all of them."""
    if columns is not None and not columns:
        raise ValueError("no column of the source is named")
    return df if columns is None else df.select(*map(quoted, columns))


def map_columns(df: DataFrame, links: Iterable[tuple[str, str | None]]) -> DataFrame:
    """Select linked columns in link order, each under its target name.

    A link ``(source, None)`` keeps the source name.
    """
    links = [(source, target or source) for source, target in links if source]
    if not links:
        raise ValueError("no column is linked to the target")
    distinct_names([target for _, target in links])
    return df.selectExpr(*[f"{quoted(source)} AS {quoted(target)}" for source, target in links])


def derive(df: DataFrame, expressions: Iterable[tuple[str, str | Column]]) -> DataFrame:
    """Add or overwrite columns in the given order, keeping all others.

    Each expression is a Column or Spark SQL text and sees the columns derived
    before it. Runs of expressions that do not mention one another become one
    projection, so that hundreds of them stay cheap to analyse.
    """
    batch: dict[str, Column] = {}
    for name, expression in expressions:
        if batch and not _independent(name, expression, batch):
            df, batch = df.withColumns(batch), {}
        batch[name] = F.expr(expression) if isinstance(expression, str) else expression
    return df.withColumns(batch) if batch else df


def conform(df: DataFrame, declared: Iterable, on_error: str = "raise") -> DataFrame:
    """Cast to the declared types, in declared order; other columns are left out.

    A value that does not fit its type fails the query, or becomes NULL with
    ``on_error="null"``; ``cast_failures`` counts those.
    """
    if on_error not in ("raise", "null"):
        raise ValueError(f"on_error must be 'raise' or 'null', not {on_error!r}")
    cast = "CAST" if on_error == "raise" else "TRY_CAST"
    return df.selectExpr(
        *[
            f"{cast}({quoted(c.name)} AS {c.spark_type}) AS {quoted(c.name)}"
            for c in _present(df, declared)
        ]
    )


def cast_failures(df: DataFrame, declared: Iterable) -> DataFrame:
    """Per declared column, the number of values that do not fit its type (one pass)."""
    declared = _present(df, declared)
    failed = [
        F.count_if(F.col(column).isNotNull() & F.col(column).try_cast(c.spark_type).isNull())
        for c, column in ((c, quoted(c.name)) for c in declared)
    ]
    counts = df.agg(*[n.alias(f"n{i}") for i, n in enumerate(failed)])
    return rows_of(
        counts,
        ["column_name", "failed_rows"],
        [(F.lit(c.name), F.col(f"n{i}")) for i, c in enumerate(declared)],
    )


def rows_of(df: DataFrame, names: Sequence[str], rows: Sequence[Sequence[Column]]) -> DataFrame:
    """Turn each row of ``df`` into one row per tuple of columns in ``rows``."""
    structs = [F.struct(*[v.alias(n) for n, v in zip(names, row)]) for row in rows]
    return df.select(F.inline(F.array(*structs)))


def distinct_names(names: Sequence[str]) -> None:
    lowered = [name.lower() for name in names]
    twice = sorted({name for name in lowered if lowered.count(name) > 1})
    if twice:
        raise ValueError(f"output columns named more than once: {twice}")


def _independent(name: str, expression: str | Column, batch: dict[str, Column]) -> bool:
    """Whether the expression surely reads none of the columns in ``batch``.

    A star that does not multiply reads them all, and a comment may hide one. The text of a
    Column may be shortened, and calls a star by another name.
    """
    text = str(expression).lower()
    if re.search(r"(^|[(,.])\s*\*|--|/\*", text):
        return False
    if not isinstance(expression, str) and re.search(r"star|\.\.\.", text):
        return False
    return not any(        "`" in pending or pending.lower() in text or pending.lower() == name.lower()
        for pending in batch
    )


def _present(df: DataFrame, declared: Iterable) -> list[Declared]:
    declared = declared_columns(declared)
    have = {name.lower() for name in df.columns}
    absent = [c.name for c in declared if c.name.lower() not in have]
    if absent:
        raise ValueError(f"declared columns are absent from the data: {absent}")
    return declared
