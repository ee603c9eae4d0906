"""Spark-native engine for structured legal text: parse, consolidate, compare, audit."""

__version__ = "0.1.0"
