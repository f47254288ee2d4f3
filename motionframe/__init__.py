"""Spark operators for motion-landmark tables, their catalogue, and training-data corpora."""
