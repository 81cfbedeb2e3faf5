"""Retail star-schema loads and data-quality checks as Spark jobs."""
