"""Operators for text and model-data pipelines. Nothing outside this subpackage imports it."""
