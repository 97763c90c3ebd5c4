"""Operators of a training-data pipeline over document, page and vector tables.

Nothing outside this subpackage imports it. ``queries.py`` holds the thin
registered queries; every other module is one operator with its own interface.
"""
