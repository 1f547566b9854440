"""Declared column types and their Spark SQL counterparts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import NamedTuple

# Declared type name -> Spark SQL type.
SPARK_TYPES = {
    "INTEGER": "INT",
    "INT": "INT",
    "BIGINT": "BIGINT",
    "SMALLINT": "SMALLINT",
    "TINYINT": "TINYINT",
    "FLOAT": "FLOAT",
    "DOUBLE": "DOUBLE",
    "REAL": "DOUBLE",
    "VARCHAR": "STRING",
    "CHAR": "STRING",
    "STRING": "STRING",
    "TEXT": "STRING",
    "CLOB": "STRING",
    "BOOLEAN": "BOOLEAN",
    "BOOL": "BOOLEAN",
    "DATE": "DATE",
    "DATETIME": "TIMESTAMP",
    "TIMESTAMP": "TIMESTAMP",
    "TIMESTAMP_NTZ": "TIMESTAMP_NTZ",
    "TIME": "STRING",
    "BINARY": "BINARY",
}
# Precision and scale of a decimal declared without them.
DEFAULT_PRECISION = 18
DEFAULT_SCALE = 2


# Further names that a mapping may use for a declaration's fields.
OTHER_FIELD_NAMES = {"name": "column", "datatype": "type"}


class Declared(NamedTuple):
    """One column of a declared schema."""

    name: str
    datatype: str = "STRING"
    precision: int | str | None = None
    scale: int | str | None = None

    @property
    def spark_type(self) -> str:
        return spark_type(self.datatype, self.precision, self.scale)


def spark_type(datatype: str, precision=None, scale=None) -> str:
    """Spark SQL type of a declared type; unknown names become STRING."""
    name = str(datatype).strip().upper()
    if name in ("DECIMAL", "NUMERIC"):
        return f"DECIMAL({_whole(precision, DEFAULT_PRECISION)},{_whole(scale, DEFAULT_SCALE)})"
    if name.startswith("DECIMAL("):
        return name
    return SPARK_TYPES.get(name, "STRING")


def declared_columns(columns: Iterable) -> list[Declared]:
    """Normalise declarations given as ``Declared``, tuples, mappings or bare names.

    Mappings have the keys of ``Declared``, or ``column`` for ``name`` and ``type`` for
    ``datatype``; further ones, such as a length, are left out. An entry without a name, no
    entry at all, or a name given twice is an error.
    """
    result = []
    for column in columns or []:
        if isinstance(column, str):
            column = Declared(column)
        elif isinstance(column, Mapping):
            given = {f: _given(column, f) for f in Declared._fields}
            column = Declared(**{"name": "", **{f: v for f, v in given.items() if v is not None}})
        else:
            column = Declared(*column)
        if not column.name:
            raise ValueError(f"a declared column has no name: {column}")
        result.append(column)
    if not result:
        raise ValueError("no columns are declared")
    names = [column.name.lower() for column in result]
    twice = sorted({name for name in names if names.count(name) > 1})
    if twice:
        raise ValueError(f"columns declared more than once: {twice}")
    return result


def _given(column: Mapping, field: str):
    value = column.get(field)
    return column.get(OTHER_FIELD_NAMES.get(field, field)) if value is None else value


def _whole(value, default: int) -> int:
    try:
        return default if value is None else int(value)
    except (TypeError, ValueError):
        return default
