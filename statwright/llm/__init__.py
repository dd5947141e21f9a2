"""Operators of a training-data pipeline: dedup, decontamination, filters,
masking, scoring, mixing and token files, each a Spark job over whole tables."""
