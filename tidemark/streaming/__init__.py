"""Incremental runs: process what is new since the checkpoint, then stop."""

from tidemark.streaming.runs import read_batches, run_each, run_foreach_batch, run_incremental

__all__ = ["read_batches", "run_each", "run_foreach_batch", "run_incremental"]
