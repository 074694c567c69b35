"""Whole jobs: parameters, lead building and the region-first variant."""
