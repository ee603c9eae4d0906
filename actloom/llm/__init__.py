"""Operators for large training-data collections; nothing outside this subpackage imports it."""
