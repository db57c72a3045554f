"""Every operator as a query over the provided tables, each next to its SQL."""

from . import prices, cleaning, safety, spatial, iris, text, rows, serving, quality, export, catalog  # noqa: F401, I001
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
