"""Order warehouse, traffic and recommendation operators on PySpark DataFrames."""
