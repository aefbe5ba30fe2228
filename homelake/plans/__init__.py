"""Whole jobs composed from functions, operators and sources."""
