"""Citation star schema on Spark: typed staging, cleaning, star tables, profiling, gates."""
