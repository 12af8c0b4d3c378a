"""Operators for preparing training text, each by the method its module names.

Nothing else in the library imports this package; the queries over the test
tables are in ``queries``.
"""
