"""Column expressions: text predicates, dates, hashing."""
