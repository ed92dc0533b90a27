"""Landed files, stored tables, and the scratch space both may need."""
