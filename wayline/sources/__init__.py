"""Readers for delimited lines, lookup tables and address lists."""
