"""DataFrame operators: joins, windows, aggregates, merges, checks."""
