"""Whole workflows, and the test tables seen as procurement data."""
