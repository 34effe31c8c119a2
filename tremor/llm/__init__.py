"""Operators for large training-data pipelines.

Nothing outside this subpackage imports it; its queries are registered by ``__spark_entry__.py`` only if it can be imported.
"""
