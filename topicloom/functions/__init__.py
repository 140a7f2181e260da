"""Column expressions: text, vectors, prompts, sampling keys."""
