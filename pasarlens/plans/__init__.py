"""Whole jobs: chains of operators from input tables to result tables."""
