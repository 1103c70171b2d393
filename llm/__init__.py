"""Operators for training-data pipelines: deduplication, scoring, tokenising, mixing and scanning of documents."""
