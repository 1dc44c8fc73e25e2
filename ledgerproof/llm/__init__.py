"""Training-data operators: one module each, their queries and SQL in ``registry``.

Nothing else in the library imports this subpackage.
"""
