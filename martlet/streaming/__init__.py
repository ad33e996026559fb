"""martlet.streaming."""
