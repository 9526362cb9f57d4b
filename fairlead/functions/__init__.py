"""Column-to-Column functions; no UDF unless a docstring says so."""
