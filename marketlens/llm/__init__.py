"""Operators for preparing training text: de-duplication, filters, tokens, scoring."""
