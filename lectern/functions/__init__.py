"""Column expressions: text, URLs, vectors, prompts and response parsing."""
