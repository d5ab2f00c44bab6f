"""Base tables and the domain views derived from them."""

from fathom.sources.tables import TABLES, read_table
from fathom.sources.views import Views

__all__ = ["TABLES", "read_table", "Views"]
