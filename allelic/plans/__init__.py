"""Registered named queries and their DuckDB oracle SQL."""
