"""The registered queries: library operators applied to the given tables, each with its SQL."""
