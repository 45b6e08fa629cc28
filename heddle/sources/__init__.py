"""Table readers with explicit schemas."""

from heddle.sources.tables import SCHEMAS, read_table

__all__ = ["SCHEMAS", "read_table"]
