"""Tabular profiling and binary classification as Spark jobs."""
