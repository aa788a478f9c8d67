"""DataFrame operators: lookup joins, last known values, keyed rows, profiling, checks."""
