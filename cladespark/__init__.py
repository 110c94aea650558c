"""Metagenome profiling on Spark DataFrames: sources, predicates, counting, taxonomy, reports."""
