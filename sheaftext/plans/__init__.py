"""Batch steps built from the operators: completeness, load, audit, retention."""
