from .tables import (TABLES, read_csv, read_table, table, table_path, using)

__all__ = ["TABLES", "read_csv", "read_table", "table", "table_path", "using"]
