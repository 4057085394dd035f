"""Variant tables on Spark: scan, annotate, filter, score and audit genomic variants as DataFrames."""
