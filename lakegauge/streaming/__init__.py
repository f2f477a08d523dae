"""Continuous runs of the bronze and silver stages."""
