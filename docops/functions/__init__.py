"""Column functions: text matching, formatting, names and mappings."""
