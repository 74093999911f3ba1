"""Operators for preparing language-model training data, as Spark jobs.

Nothing else in this library imports this subpackage; ``__spark_entry__.py`` adds its queries if it is there.
"""
