"""Operators for preparing training data: thirteen operators, one module each.

Nothing else in the library imports this package; ``__spark_entry__`` adds its
queries when it is present.
"""
