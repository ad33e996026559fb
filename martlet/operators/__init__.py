"""martlet.operators."""
