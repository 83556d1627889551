"""Clinical observation reporting on Spark DataFrames."""
