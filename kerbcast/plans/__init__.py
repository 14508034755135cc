"""Whole jobs: training, experiments, and the life of a model."""
