"""Claims lakehouse operators for PySpark: DataFrames in, DataFrames out."""
