"""Operators of a training-data pipeline over tables of documents.

Each module holds one operator with its own general interface; ``queries`` binds the registered
queries to them and ``oracle`` holds the DuckDB SQL for those that SQL can express. Nothing else in
the library imports this subpackage.
"""
