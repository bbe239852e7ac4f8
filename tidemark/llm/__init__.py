"""Operators of a large training-data pipeline; ``registry`` lists their queries.

Nothing else in the library imports this package, so it can be removed whole.
"""
