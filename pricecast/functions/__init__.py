"""Column functions: every one takes and returns Spark columns, none is a Python UDF."""
