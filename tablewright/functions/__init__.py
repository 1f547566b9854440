from tablewright.functions.text import comparable_text, standardize_name
from tablewright.functions.types import Declared, declared_columns, spark_type

__all__ = ["Declared", "comparable_text", "declared_columns", "spark_type", "standardize_name"]
