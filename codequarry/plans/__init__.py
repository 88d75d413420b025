"""Registered queries, their SQL checks, and the test corpora derived from the given tables."""
