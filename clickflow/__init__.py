"""Clickstream session analytics as Spark DataFrame pipelines."""
