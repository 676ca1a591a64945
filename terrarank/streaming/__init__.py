"""Incremental maintenance of the class-composition panel with Structured Streaming."""

from terrarank.streaming.landing import panel_sums, read_panel, shares_from_sums, start_panel_stream

__all__ = ["panel_sums", "read_panel", "shares_from_sums", "start_panel_stream"]
