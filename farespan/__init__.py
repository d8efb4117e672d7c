"""Airline revenue reporting on Spark: DataFrame transforms and report plans."""
