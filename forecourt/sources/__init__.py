"""Zone tables, delimited extracts and databases."""
