"""DataFrame -> DataFrame operators. Each function takes and returns Spark
DataFrames, with every threshold the reference leaves open as a parameter."""
