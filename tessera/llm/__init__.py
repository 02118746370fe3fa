"""Operators of a training-data pipeline.

Ten operators over documents, pages, embeddings and conversations, each by a
named method (see the module docstrings). Nothing else in the library imports
this subpackage; ``queries`` holds the registered queries and their SQL.
"""
