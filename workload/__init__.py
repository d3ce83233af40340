"""The registered queries: inputs from the given tables, queries, SQL to compare."""
