"""Readers that produce staging-shaped frames."""
