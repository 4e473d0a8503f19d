"""Whole jobs, and the queries that run each operator on the standard tables."""
