"""Structured Streaming forms of the bank jobs."""

from tabsmith.streaming.bank import cleaned_stream, failed_stream, run_clean_stream, run_failed_stream

__all__ = ["cleaned_stream", "failed_stream", "run_clean_stream", "run_failed_stream"]
