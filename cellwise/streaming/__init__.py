"""Structured Streaming jobs."""

from cellwise.streaming.scoring import request_stream, score_batch, score_stream

__all__ = ["request_stream", "score_batch", "score_stream"]
