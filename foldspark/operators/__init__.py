"""Relational, resampling, feature, model and metric operators."""
