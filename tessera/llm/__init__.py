"""Operators of a training-data pipeline, one module each; ``registry`` names their queries."""
