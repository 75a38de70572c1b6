"""tillroll: a retail warehouse, its quality checks and its analysis as Spark DataFrames."""
