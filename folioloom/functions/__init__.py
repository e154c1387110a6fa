"""Column expressions: text, tokens, vectors."""
