"""Structured Streaming forms of the session and insert-only merge
operators (SURVEY §2.1 A22-A23)."""
