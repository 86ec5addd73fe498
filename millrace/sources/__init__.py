"""Readers and writers. Every schema is explicit; nothing is inferred from data."""
