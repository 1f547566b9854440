from tablewright.sources.tables import ensure_table, load_overwrite, read_table, table_name

__all__ = ["ensure_table", "load_overwrite", "read_table", "table_name"]
