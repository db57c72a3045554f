"""Jobs: raw files to clean tables, clean tables to published indicators."""
