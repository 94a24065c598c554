"""Column functions: safe parsing, predicate templates and value normalizers."""
