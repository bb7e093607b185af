"""Column functions: casts, amounts, dates, names and user-declared expressions."""
