"""Batch operators over source texts and node tables."""
