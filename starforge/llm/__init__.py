"""Operators for large training corpora: archives, formatting, tokens, filters, de-duplication.

Nothing else in the library imports this subpackage. Every operator module
offers DataFrame -> DataFrame functions; ``queries.py`` holds the thin
registered queries and their SQL.
"""
