"""Whole jobs: the operators put together, from input tables to result tables."""
