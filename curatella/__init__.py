"""Curation analytics on Spark: pure DataFrame-to-DataFrame operators for research catalogues."""
