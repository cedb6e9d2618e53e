"""Column expressions: text to terms and vectors, rows to fingerprints."""
