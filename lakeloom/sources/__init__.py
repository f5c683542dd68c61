"""Readers: files, JSON path mappings, HTML pages, named tables."""
