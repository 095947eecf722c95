"""Composite queries, the batch job and the test-data stand-ins."""
