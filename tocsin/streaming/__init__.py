"""Structured Streaming jobs: wall clock (keyed state) and replay (set-oriented)."""
