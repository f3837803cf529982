"""Frame-axis analytics on PySpark: operators are pure functions from DataFrames to DataFrames."""
