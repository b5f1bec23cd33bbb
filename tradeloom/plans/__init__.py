"""Whole jobs and reports assembled from operators."""
