"""DataFrame operators: parsing, lookups, tagging, ids."""
