"""Structured Streaming entry points."""

from cropwire.streaming.landing import close_cycle, repeat_runs, run_available, stream_climate, stream_keyed, stream_market

__all__ = ["close_cycle", "repeat_runs", "run_available", "stream_climate", "stream_keyed", "stream_market"]
