"""Whole pipelines, the inputs derived from the test tables and the registered queries."""
