"""Operators that prepare training text, each with its registered query.

Nothing outside this subpackage imports it.
"""
