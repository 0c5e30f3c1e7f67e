"""Readers: files and text columns in, one row per document or block out."""
