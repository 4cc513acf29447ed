"""Column functions: numbers, text, dates, predicates, and their SQL names."""
