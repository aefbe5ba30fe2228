"""Registered queries and their checks."""
