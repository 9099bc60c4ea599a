"""PySpark library for an open-data catalogue: sources, normalisers, search, checks."""
