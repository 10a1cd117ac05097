"""Relational operators over pitch logs and game tables."""
