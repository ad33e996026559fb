"""martlet.plans."""
