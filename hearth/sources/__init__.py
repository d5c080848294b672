"""Table sources and sinks; ``sites``: many site copies as one; ``warehouse``: repeatable loads."""

from .io import (append_table, existing_paths, generate_ids, import_audit_row, literal_rows, overwrite_table, path_exists,
                 read_csv, read_jdbc, read_sites, read_table, register_year_views, year_slice)

__all__ = ["append_table", "existing_paths", "generate_ids", "import_audit_row", "literal_rows", "overwrite_table", "path_exists",
           "read_csv", "read_jdbc", "read_sites", "read_table", "register_year_views", "year_slice"]
