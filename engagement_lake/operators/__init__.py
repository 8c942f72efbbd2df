"""Reusable relational steps: keep-first, latest values, shared measures."""
