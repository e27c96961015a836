"""Structured Streaming: sources, windowed state, metric sinks, snapshots."""
