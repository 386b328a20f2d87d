"""Column expressions: text, prompts, model replies, vectors."""
