"""Composite plans: the reference's datasets and reports as DataFrame
functions, plus the registry of named queries and their SQL twins."""
