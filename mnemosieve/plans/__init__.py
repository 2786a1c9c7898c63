"""Whole requests: the engine over a versioned index, and saving with candidates."""
