"""Whole query plans, each with the SQL that states the same result."""
