"""DataFrame operators: validation, deduplication, references, reports and landing checks."""
