"""Training-data operators and the queries that apply them to whole tables.

Nothing else in the library imports this subpackage.  ``registry.py`` lists its
queries; each operator has a module of its own.
"""
