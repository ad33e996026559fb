"""martlet.verify."""
