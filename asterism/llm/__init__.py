"""Operators for preparing training text: ten of them, one module each, and their queries."""
