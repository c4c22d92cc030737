"""Column expressions: text cleaning, bibliography building and predicates."""
