"""Rollcall: a PySpark-native analytics engine for parliamentary and electoral records."""

__version__ = "0.1.0"
