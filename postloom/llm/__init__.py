"""Operators that prepare training text: one module each, plus their queries."""
