"""Column functions: text, vectors, sessions, word pieces."""
