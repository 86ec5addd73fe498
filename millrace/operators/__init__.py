"""Operators that need more than one row, an Arrow helper, or both."""
