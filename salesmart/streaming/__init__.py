"""Structured Streaming re-aims of the incremental fact load (SM1-SM3)."""
