"""Operators for preparing language-model training data, as Spark jobs.

Nothing else in the library imports this subpackage. Each ``opN_*`` module holds one operator
with its general interface and the thin registered query; ``registry`` lists queries and SQL.
"""
