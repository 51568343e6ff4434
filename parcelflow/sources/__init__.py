"""Inputs: stored pages, statistics sheets, stage tables, the test tables."""
