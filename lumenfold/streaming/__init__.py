"""Structured Streaming forms of the operators."""

from lumenfold.streaming.durable import durable_hash_sample, merged_moments, read_durable, write_checked, write_durably
from lumenfold.streaming.sampling import run_to_end, stream_hash_sample

__all__ = [
    "durable_hash_sample",
    "merged_moments",
    "read_durable",
    "run_to_end",
    "stream_hash_sample",
    "write_checked",
    "write_durably",
]
