"""Readers and writers for reviews, sampling log, batches, coding files, codebooks and run records."""
