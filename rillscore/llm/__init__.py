"""Operators for training-data pipelines: scoring, mixing, near duplicates, decontamination, search, formatting, archives.

Every operator takes DataFrames and column names, selects only the columns it needs (extra columns never clash) and
returns a DataFrame. Nothing outside this subpackage imports it.
"""
