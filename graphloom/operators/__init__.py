"""Operators beyond the algebra: paths, rules, native graph queries and updates."""
