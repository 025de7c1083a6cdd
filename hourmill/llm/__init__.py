"""Operators for preparing training text (documents in, decisions, ids and files out).

Nothing else in the library imports this subpackage.
"""
