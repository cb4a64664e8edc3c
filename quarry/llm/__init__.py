"""Operators for preparing training data: packing, decontamination, near-duplicates, language, HTML, scoring.

Each operator is a function of DataFrames in a module of its own. ``queries.py``
applies them to the tables of a data directory. Nothing outside this package imports it.
"""
