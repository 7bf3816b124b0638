"""Operators for large-scale training-data pipelines, as Spark jobs over document tables."""
