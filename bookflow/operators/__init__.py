"""Relational operators over page, line, section and checkpoint tables."""
