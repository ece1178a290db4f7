"""Routing-contact analytics and training-data preparation as Spark jobs."""
