"""Dimensions (languages, rules), loaders, file selection, admission and sinks."""
