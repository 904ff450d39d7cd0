"""Structured Streaming: running flows to an end, keyed state, panes."""
