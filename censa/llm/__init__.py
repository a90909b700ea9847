"""Operators for training-data pipelines; nothing else in the library imports this folder.

Each module is one operator with its own interface and real outputs.  ``queries``
registers them over the given tables.
"""
