"""Operators: feature stages, learners, metrics, projections and preview."""
