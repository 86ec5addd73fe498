"""Operators for preparing training data, one module each; nothing outside this folder imports them."""
