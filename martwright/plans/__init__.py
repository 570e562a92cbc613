"""Declared schemas, the wide datasets, the marts and the refresh job."""
