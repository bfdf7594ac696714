"""Table sinks with observed row counts."""

from .tables import (append_evolving, overwrite_from_self, replace_scope, show_preview,
                     write_table)

__all__ = ["append_evolving", "overwrite_from_self", "replace_scope", "show_preview",
           "write_table"]
