"""Continuous forms of the ingest and refine jobs."""
