"""Operators composed from DataFrame joins, windows and aggregates."""
