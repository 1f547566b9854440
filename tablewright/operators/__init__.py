from tablewright.operators import aggregates, checks, columns, joins, ranges, reconcile, rows

__all__ = ["aggregates", "checks", "columns", "joins", "ranges", "reconcile", "rows"]
