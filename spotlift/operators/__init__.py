"""Relational operators: staging, interval and as-of joins, window counts, checks, forest."""
