"""Key numbering, quality checks and constraints on any frame."""
