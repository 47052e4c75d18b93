"""Broadsheet: press-article analytics as PySpark DataFrame operators."""
