"""Whole jobs: the feature table, report tables, models, and the batch run of all three."""
