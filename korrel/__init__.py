"""korrel: record linkage on PySpark DataFrames."""
