"""Structured Streaming: windows over event time, deduplication in bounded state, archives as they arrive."""
