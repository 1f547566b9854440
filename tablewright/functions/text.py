"""Column functions on text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def standardize_name(column: str | Column) -> Column:
    """Upper case without surrounding spaces."""
    return F.upper(F.trim(as_column(column)))


def comparable_text(column: str | Column) -> Column:
    """The text by which two values are compared: trimmed, NULL kept as NULL."""
    return F.trim(as_column(column).cast("string"))


def as_column(column: str | Column) -> Column:
    return F.col(quoted(column)) if isinstance(column, str) else column


def quoted(name: str) -> str:
    """A column or table name as a SQL identifier, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"
