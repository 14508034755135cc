"""The registered queries: each runs a library operator on the benchmark tables, next to
the SQL another engine needs for the same answer."""
