"""Models of the warehouse: each function takes and returns DataFrames and leaves the physical plan to Spark."""
