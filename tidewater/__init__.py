"""Round-based sequence analytics on Spark: DataFrame operators, sources, sinks and reports."""
