"""Scans: delimited files and lines, configuration text, landing folders and ratings files."""
