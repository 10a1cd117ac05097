"""Structured Streaming: keep the game table current as pitch-log files arrive."""
