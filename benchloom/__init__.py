"""Complete benchmark datasets on Spark: generate, check, publish, verify, query."""
