"""Scoring of request payloads and of file streams (Structured Streaming)."""

from lodestar.streaming.scoring import parse_requests, score_requests, stream_score

__all__ = ["parse_requests", "score_requests", "stream_score"]
