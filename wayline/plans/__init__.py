"""Whole jobs: lookup-table builds, file import, load reports."""
