"""Operators for preparing training text; the rest of the library does not import this package."""
