"""Structured Streaming: the settle window and the follower of a change feed."""
