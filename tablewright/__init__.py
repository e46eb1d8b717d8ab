"""Spark-first operators for tabular analytics and machine-learning jobs."""
