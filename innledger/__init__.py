"""Hotel operations analytics as Spark DataFrame pipelines."""
