"""martlet.sources."""
