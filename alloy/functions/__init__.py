"""Column expressions: text rules, safe casts, predicates."""
