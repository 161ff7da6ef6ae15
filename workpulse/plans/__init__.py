"""Pipelines and the registered query catalog."""
