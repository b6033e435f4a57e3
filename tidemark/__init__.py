"""Layered (landed, bronze, silver, gold) analytics as plain Spark DataFrame functions."""

from tidemark.session import scratch_dir, start_session

__all__ = ["scratch_dir", "start_session"]
