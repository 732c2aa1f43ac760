"""Case-control, incident-cohort and genotype-association analytics on Spark DataFrames."""

__version__ = "0.1.0"
