"""Assayer: evidence preparation, scoring and association roll-up on PySpark."""
