"""Qualitative-coding analytics as Spark jobs.

Every operator takes DataFrames and returns DataFrames; ``app`` is a column, so one job serves all
collections at once.
"""
