"""User-level operators."""
