"""Operators for building training data from large text collections.

One module per operator; ``registry`` holds the acceptance queries and their
DuckDB SQL. Nothing else in the library imports this subpackage.
"""
