"""Column expressions: amounts, identifiers, hashing, time and risk grading."""
