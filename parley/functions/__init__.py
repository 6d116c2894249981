"""Column expressions: text, windows, dictionaries, scores."""
