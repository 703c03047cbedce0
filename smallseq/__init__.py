"""Spark-first small-RNA quantification: sources, rules, interval assignment, counts and reports as DataFrames."""
