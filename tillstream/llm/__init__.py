"""Operators for preparing training text; see the modules for each."""
