"""Structured Streaming: parse a JSON stream (T1), per-micro-batch quality metrics (T2-T4),
progress capture (T5-T7)."""
