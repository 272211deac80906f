"""Labelling, profiling, classifying and evaluating network flows with Spark DataFrames."""
