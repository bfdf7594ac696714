"""Sources: files, catalog tables, inline relations, schema harvest."""

from .catalog import (create_database, read_table, register_sources,
                      snapshot_schema, table_exists, use_database)
from .files import read_csv, read_parquet_table

__all__ = ["create_database", "read_table", "register_sources",
           "snapshot_schema", "table_exists", "use_database", "read_csv",
           "read_parquet_table"]
