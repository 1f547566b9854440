"""Row filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def keep(df: DataFrame, predicate: str | Column) -> DataFrame:
    """Rows for which the predicate is true; NULL counts as not true."""
    if isinstance(predicate, str):
        if not predicate.strip():
            raise ValueError("filter has no predicate")
        predicate = F.expr(predicate)
    elif predicate is None:
        raise ValueError("filter has no predicate")
    return df.filter(predicate)
